"""Queries of the text problems (2, 6, 7, 8, 9) over the project's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialise, table
from . import bpe, copies, markup, mixture, residue
from .sql import SQL


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """field_value_id of each field whose raw_text or raw_markup holds markup."""
    fields = table(spark, d, "raw_field").select("field_value_id", "raw_text", "raw_markup")
    return markup.marked_up(fields, "raw_text", "raw_markup").select("field_value_id")


def p2_clean(spark: SparkSession, d: str) -> DataFrame:
    """Every field's text (its markup where there is any, else its text) as clean text with its blocks."""
    fields = table(spark, d, "raw_field").select("field_value_id", "field_name", F.coalesce("raw_markup", "raw_text").alias("source_text"))
    return markup.cleaned(fields, "source_text").drop("source_text")


def _items(spark: SparkSession, d: str) -> copies.Copies:
    return copies.Copies(table(spark, d, "catalogue_item"), "item_id", ["name", "url"], ["attrs"])


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """item_id_kept and item_id_copy of each item that repeats another."""
    return _items(spark, d).members()


def p6_records(spark: SparkSession, d: str) -> DataFrame:
    """One record per item with its number of copies and of spellings."""
    return _items(spark, d).records()


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    """doc_id and token ids of each document."""
    return bpe.encode_corpus(table(spark, d, "documents"), ["doc_id"])


def p7_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """doc_id, number of tokens, and whether decoding gives back the text (null as empty) of each document."""
    docs = table(spark, d, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    encoded = docs.withColumn("ids", bpe.ids_column(F.col("text")))
    return encoded.select("doc_id", F.size("ids").alias("n_tokens"), (bpe.decode_column(F.col("ids")) == F.col("text")).alias("same"))


def _mixture(spark: SparkSession, d: str, total: float | str | None = "exact", weight: Column | None = None) -> mixture.Mixture:
    # "exact": the largest mixture in which every source with records has its share exactly; None: the size of the corpus
    return mixture.Mixture(mixture.sized(table(spark, d, "documents"), weight=weight), table(spark, d, "mix_target"), total=total)


def _quality_weight() -> Column:
    """A record's relative weight: texts with a title and a section count more, short ones less; unequal within every source."""
    named = F.lit(1.0) + F.col("title").isNotNull().cast("double") + F.col("section_name").isNotNull().cast("double")
    return named * F.least(F.lit(1.0), F.coalesce(F.col("n_chars"), F.lit(0)) / 400.0)


def p8_mixture(spark: SparkSession, d: str) -> DataFrame:
    """doc_id, source, n_tokens and copies of each document of the mixture."""
    return _mixture(spark, d).chosen.withColumnRenamed("id", "doc_id")


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    """Target, given and reached size of each source."""
    return _mixture(spark, d).shares()


def p8_mixture_corpus(spark: SparkSession, d: str) -> DataFrame:
    """As p8_mixture at the size of the corpus: shares are met as nearly as max_repeats allows."""
    return _mixture(spark, d, None).chosen.withColumnRenamed("id", "doc_id")


def p8_shares_corpus(spark: SparkSession, d: str) -> DataFrame:
    """Target, given and reached size of each source at the size of the corpus."""
    return _mixture(spark, d, None).shares()


def p8_mixture_weighted(spark: SparkSession, d: str) -> DataFrame:
    """As p8_mixture_corpus, records drawn by weight: inclusion odds are unequal within a source."""
    m = _mixture(spark, d, None, _quality_weight())
    return m.chosen.withColumnRenamed("id", "doc_id")


def p8_shares_weighted(spark: SparkSession, d: str) -> DataFrame:
    """Target, given and reached size of each source of the weighted mixture."""
    return _mixture(spark, d, None, _quality_weight()).shares()


#: Tokens of a mixture too large for every source but the widest, so max_repeats binds.
LARGE = 1e12


def p8_shares_large(spark: SparkSession, d: str) -> DataFrame:
    """Shares of a mixture of LARGE tokens: every source is given max_repeats times its size."""
    return _mixture(spark, d, LARGE).shares().select("source", "target_share", "max_repeats", "records", "copies", "most_copies", "tokens", "reached_tokens")


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """doc_id of each document with residue."""
    return residue.flagged(table(spark, d, "documents")).select("doc_id")


def p9_reasons(spark: SparkSession, d: str) -> DataFrame:
    """doc_id and kinds of residue of each document with residue."""
    return residue.flagged(table(spark, d, "documents")).select("doc_id", F.array_join("kinds", ",").alias("kinds"))


def p9_kept(spark: SparkSession, d: str) -> DataFrame:
    """The documents without residue."""
    docs = table(spark, d, "documents")
    return docs.join(materialise(residue.flagged(docs).select("doc_id")), "doc_id", "left_anti").select("doc_id", "source", "lang", "text")


QUERIES = {
    "p2_found": p2_found, "p2_clean": p2_clean, "p6_found": p6_found, "p6_records": p6_records, "p7_ids": p7_ids, "p7_roundtrip": p7_roundtrip,
    "p8_mixture": p8_mixture, "p8_shares": p8_shares, "p8_mixture_corpus": p8_mixture_corpus, "p8_shares_corpus": p8_shares_corpus, "p8_mixture_weighted": p8_mixture_weighted, "p8_shares_weighted": p8_shares_weighted, "p8_shares_large": p8_shares_large, "p9_found": p9_found, "p9_reasons": p9_reasons, "p9_kept": p9_kept,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
