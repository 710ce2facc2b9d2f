"""Full-text search over an inverted index, and fuzzy candidates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx


def inverted_index(docs: DataFrame, id_column: str, text: Column) -> DataFrame:
    """term, id, tf, size: how often each term stands in each document, and the document's terms.

    Written once, it serves every query; over an index that isn't written, a search's terms are filtered before the
    grouping, so only their rows shuffle. Words are stemmed after they are exploded, in generated code.
    """
    words = tx.tokens(text)
    size = F.size(F.filter(words, lambda w: ~w.isin(*tx.STOPWORDS)))
    exploded = docs.select(F.col(id_column), size.alias("size"), F.explode(words).alias("_w")).where(~F.col("_w").isin(*tx.STOPWORDS))
    return exploded.select(id_column, "size", tx.stem(F.col("_w")).alias("term")).groupBy("term", id_column, "size").agg(F.count("*").alias("tf"))


def all_terms(index: DataFrame, id_column: str, wanted: Sequence[str]) -> DataFrame:
    """Documents that hold all wanted terms (already stemmed), with rank = Σ tf / (1 + ln size). No terms find nothing."""
    needed = sorted(set(wanted))
    hits = index.where(F.col("term").isin(*needed)) if needed else index.where("false")
    return hits.groupBy(id_column, "size").agg(F.count("*").alias("_n"), F.sum("tf").alias("_tf")).where(F.col("_n") == len(needed)).select(id_column, F.round(F.col("_tf") / (1 + F.log(F.col("size").cast("double"))), 6).alias("rank"))


def query_terms(spark, query: str) -> list[str]:
    """The stems of a query's words, in Python's hands: one small row."""
    return list(spark.range(1).select(tx.terms(F.lit(query)).alias("t")).first().t)


def fuzzy(names: DataFrame, id_column: str, name: str, probe: str, least: float = 0.3, most: int = 10) -> DataFrame:
    """The names most similar to a probe by trigrams; ties by id."""
    score = F.round(tx.similarity(tx.trigrams(F.col(name)), tx.trigrams(F.lit(probe))), 6)
    return names.select(id_column, name, score.alias("similarity")).where(F.col("similarity") > least).orderBy(F.desc("similarity"), id_column).limit(most)


def fuzzy_join(left: DataFrame, left_id: str, left_name: str, right: DataFrame, right_id: str, right_name: str, least: float = 0.3) -> DataFrame:
    """Pairs whose trigram similarity exceeds `least`: candidates share a trigram of the left name's prefix, by prefix filtering.

    With trigrams ordered by rarity, names with similarity over t share one of the first n - ceil(t n) + 1 trigrams of
    either side, so only rare trigrams meet and no pair is lost.
    """
    l = left.select(F.col(left_id).alias("_l"), tx.trigrams(F.col(left_name)).alias("_lt")).where(F.size("_lt") > 0)  # noqa: E741
    r = right.select(F.col(right_id).alias("_r"), tx.trigrams(F.col(right_name)).alias("_rt")).where(F.size("_rt") > 0)
    grams = l.select(F.explode("_lt").alias("g")).unionAll(r.select(F.explode("_rt").alias("g"))).groupBy("g").agg(F.count("*").alias("n"))

    def prefix(df: DataFrame, key: str, set_: str) -> DataFrame:
        each = df.select(key, F.size(set_).alias("_size"), F.explode(set_).alias("g")).join(grams, "g")
        ordered = each.groupBy(key, "_size").agg(F.array_sort(F.collect_list(F.struct("n", "g"))).alias("_o"))
        keep = F.col("_size") - F.ceil(F.col("_size") * least) + 1
        return ordered.select(key, F.explode(F.slice("_o", F.lit(1), F.greatest(F.lit(1), keep).cast("int"))).alias("_p")).select(key, F.col("_p.g").alias("g"))

    pairs = prefix(l, "_l", "_lt").join(prefix(r, "_r", "_rt"), "g").select("_l", "_r").distinct()
    scored = pairs.join(l, "_l").join(r, "_r").withColumn("similarity", F.round(tx.similarity(F.col("_lt"), F.col("_rt")), 6))
    return scored.where(F.col("similarity") > least).select(F.col("_l").alias(f"{left_id}_left"), F.col("_r").alias(f"{right_id}_right"), "similarity")
