"""Views over claims: what sources say about an entity's metric in a period, on three clocks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .relational import first_by


def source_claims(claims: DataFrame, by: Sequence[str], value: str, dataset: str, edition: str) -> DataFrame:
    """Per key: claims, distinct values, least and greatest value, the data sets and editions, ordered. Null values count as claims only."""
    return claims.groupBy(*by).agg(
        F.count("*").alias("claims"), F.count_distinct(value).alias("distinct_values"), F.min(value).alias("min_value"), F.max(value).alias("max_value"),
        F.array_join(F.array_sort(F.collect_set(F.col(dataset).cast("string"))), ",").alias("datasets"), F.array_join(F.transform(F.array_sort(F.collect_set(F.col(edition).cast("int"))), lambda e: e.cast("string")), ",").alias("editions"),
    )


def conflicts(grouped: DataFrame) -> DataFrame:
    """Groups whose sources disagree, with the ratio of greatest to least value (null where the least is 0)."""
    return grouped.where("distinct_values > 1").withColumn("ratio", F.try_divide(F.col("max_value").cast("double"), F.col("min_value").cast("double")))


def latest(claims: DataFrame, keys: Sequence[str], clock: Sequence[str], unique: str) -> DataFrame:
    """The latest claim of each key by the clocks named, nulls last, then by id."""
    return first_by(claims, keys, [*(F.col(c).desc_nulls_last() for c in clock), F.col(unique).desc_nulls_last()])


def change(series: DataFrame, keys: Sequence[str], year: str, value: str) -> DataFrame:
    """series with the change since the row before, absolute and in percent to two places; null for the first and after 0."""
    before = F.lag(value).over(Window.partitionBy(*keys).orderBy(year))
    return series.withColumns({
        "absolute_change": F.col(value) - before,
        "percent_change": F.round(100 * F.try_divide((F.col(value) - before).cast("double"), before.cast("double")), 2),
    })


def best_per(df: DataFrame, key: str, value: Column, order: Sequence[Column]) -> DataFrame:
    """One value per key, the first in an order: the correlated scalar top-1 as an aggregate."""
    return df.groupBy(key).agg(F.min_by(value, F.struct(*order)).alias("best"))


def coverage(files: DataFrame, records: DataFrame, fields: DataFrame) -> DataFrame:
    """Per file: entries, distinct sources, fields and values. Each side is aggregated to the file before it is joined."""
    r = records.groupBy("artifact_id").agg(F.count_distinct("record_id").alias("records"), F.count_distinct("source_key").alias("sources"))
    f = fields.groupBy("artifact_id").agg(F.count_distinct("field_name").alias("fields"), F.count("*").alias("values"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return files.join(r, "artifact_id", "left").join(f, "artifact_id", "left").select("artifact_id", "dataset_code", "edition_year", zero("records"), zero("sources"), zero("fields"), zero("values"))
