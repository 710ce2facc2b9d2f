"""The dimensional mart: dimensions first, then facts, as tables a later job reads."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def dim_period(first: Column, last: Column, source: DataFrame) -> DataFrame:
    """One row per month between the first and last day of a table: key yyyymm, year, quarter, month, label, start."""
    span = source.agg(F.trunc(F.min(first), "month").alias("a"), F.trunc(F.max(last), "month").alias("b"))
    months = span.select(F.explode(F.sequence("a", "b", F.expr("interval 1 month"))).alias("start"))
    year, month = F.year("start"), F.month("start")
    return months.select((year * 100 + month).alias("period_key"), year.alias("year"), F.quarter("start").alias("quarter"), month.alias("month"), F.date_format("start", "yyyy-MM").alias("label"), "start")


def dim_entity(entities: DataFrame) -> DataFrame:
    """entity_key, source_key, name by a ladder of fallbacks, region, whether the entity is current."""
    name = F.coalesce(F.nullif(F.trim("label"), F.lit("")), F.upper("source_key"), F.lit("unnamed"))
    return entities.select(F.xxhash64("source_key").alias("entity_key"), "source_key", name.alias("entity_name"), F.coalesce("region_name", F.lit("unknown")).alias("region"), F.col("valid_to").isNull().alias("is_current"))


def fact_observation(claims: DataFrame, metrics: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """Claims of metrics of the given quantity kinds. metrics is a reference table; Spark broadcasts it while it is small."""
    held = metrics.where(F.col("quantity_kind").isin(*kinds)).select("metric_code", "quantity_kind", "base_unit")
    return claims.join(held, "metric_code")


def refresh(tables: dict[str, DataFrame], folder: str) -> dict[str, int]:
    """Write tables in the order given (dimensions before facts), each a new version beside the old ones; the number of rows of each.

    A version is named in the folder's list of versions only when it is whole, so a failed job leaves the tables that
    were there. Rows are counted while they are written.
    """
    counts = {}
    for name, df in tables.items():
        seen = Observation(f"rows_{name}")
        version = uuid.uuid4().hex
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(f"{folder}/{name}/version={version}")
        listed = df.sparkSession.range(1).select(F.lit(version).alias("version"), F.current_timestamp().alias("at"))
        listed.write.mode("append").parquet(f"{folder}/_versions/{name}")
        counts[name] = seen.get["rows"]
    return counts


def current(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The last whole version of a table of a refreshed folder."""
    version = spark.read.parquet(f"{folder}/_versions/{name}").orderBy(F.desc("at")).first()["version"]
    return spark.read.parquet(f"{folder}/{name}/version={version}")


def analyse(table: DataFrame) -> DataFrame:
    """column, rows, nulls, distinct, least, greatest: statistics of a table, in one pass, distinct counts approximate."""
    plain = [f.name for f in table.schema.fields if f.dataType.typeName() not in ("array", "map", "struct", "binary", "variant")]
    parts = [F.struct(F.lit(c).alias("column"), F.count("*").alias("rows"), F.count_if(F.col(c).isNull()).alias("nulls"), F.approx_count_distinct(c).alias("distinct"), F.min(c).cast("string").alias("least"), F.max(c).cast("string").alias("greatest")) for c in plain]
    return table.agg(F.array(*parts).alias("s")).select(F.inline("s"))
