"""Duplicates hidden by formatting differences.

Byte-identical rows are collapsed first, with counts; only the distinct survivors are made canonical, and those are
grouped again on their full canonical text, summing the counts. Both groupings combine on the map side, so a record
with a third of all rows costs no more than any other. Kept ids go back to rows by joins whose hot keys (each with
more than one in SHARE of all rows, so at most SHARE of them) are broadcast, and only the others shuffled.

Canonical text: letters, digits and combining marks in their order, case-folded, in composed form, so accents count
and white space, punctuation and invisible characters don't. The entries of a set-like column are sorted.
Null and empty values are equal to each other. Rows with a null id take part in counts and never are the kept id
unless all ids of their group are null.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialise

#: One in so many rows makes a key hot; so many keys at most can be hot.
SHARE = 1000
#: Where an entry of a set-like column begins: after a separator, before a key with = or :.
ENTRIES = r"[;|,\n](?=\s*[^;|,\n=:]+[=:])"
_DROP = regex.compile(r"[^\p{L}\p{N}\p{M}]+")
_ENTRIES = regex.compile(ENTRIES)


def canonical(text: str | None) -> str:
    """Letters, digits and marks of a text."""
    return _DROP.sub("", unicodedata.normalize("NFC", unicodedata.normalize("NFC", text).casefold())) if text else ""


def canonical_entries(text: str | None) -> str:
    """The canonical entries of a set-like text, sorted."""
    return "\x1f".join(sorted(canonical(e) for e in _ENTRIES.split(text))) if text else ""


@F.pandas_udf(T.StringType())
def _canonical(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: canonical(t) if isinstance(t, str) else "")


@F.pandas_udf(T.StringType())
def _canonical_entries(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: canonical_entries(t) if isinstance(t, str) else "")


def canonical_column(text: Column, entries: bool = False) -> Column:
    """Canonical text of a column; ASCII texts, the most, never leave the JVM."""
    value = F.coalesce(text.cast("string"), F.lit(""))
    plain = lambda c: F.regexp_replace(F.lower(c), "[^a-z0-9]+", "")
    fast = F.array_join(F.array_sort(F.transform(F.split(value, ENTRIES), plain)), "\x1f") if entries else plain(value)
    ascii_only = ~value.rlike(r"[^\x00-\x7f]")
    slow = (_canonical_entries if entries else _canonical)(F.when(~ascii_only, value))
    return F.when(value == "", F.lit("")).when(ascii_only, fast).otherwise(slow)


def attach(rows: DataFrame, lookup: DataFrame, key: str, weight: str, total: int, keep: Sequence[str]) -> DataFrame:
    """rows ⋈ lookup on `key` (unique in lookup): hot keys by broadcast, the others by shuffle. `weight` of lookup is the rows per key."""
    hot = lookup.where(F.col(weight) * SHARE > total).select(key, *keep, F.lit(True).alias("_hot"))
    first = rows.join(F.broadcast(hot), key, "left")
    rest = first.where("_hot is null").drop("_hot", *keep).join(lookup.where(F.col(weight) * SHARE <= total).select(key, *keep), key)
    return first.where("_hot").drop("_hot").unionByName(rest)


class Copies:
    """Groups of equal records of one table."""

    def __init__(self, df: DataFrame, id_column: str, texts: Sequence[str], sets: Sequence[str] = ()):
        self.df, self.id, self.texts, self.sets = df, id_column, list(texts), list(sets)
        columns = [*self.texts, *self.sets]
        survivors = df.select(F.col(id_column).alias("_id"), *columns).groupBy(*columns).agg(F.count("*").alias("n"), F.min("_id").alias("_id"))
        parts = [canonical_column(F.col(c)) for c in self.texts] + [canonical_column(F.col(c), entries=True) for c in self.sets]
        keyed = survivors.withColumn("canonical", F.concat_ws("\x1e", *parts)).withColumn("digest", self._digest())
        self.survivors = materialise(keyed)
        self.groups = materialise(
            self.survivors.groupBy("canonical").agg(F.sum("n").alias("copies"), F.count("*").alias("variants"), F.min("_id").alias("kept"), F.min_by(F.struct(*columns), F.struct(F.col("_id").isNull(), "_id")).alias("record"))
        )
        sizes = self.groups.agg(F.sum("copies"), F.sum("variants")).first()
        self.rows, self.distinct = sizes[0] or 0, sizes[1] or 0

    def _digest(self) -> Column:
        """A key of the byte-identical row: SHA-256 over length-prefixed values, null apart from empty."""
        value = lambda c: F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), F.col(c)), F.lit("~"))
        return F.unhex(F.sha2(F.concat_ws("|", *(value(c) for c in [*self.texts, *self.sets])), 256))

    def records(self) -> DataFrame:
        """One row per record: kept id, the texts of the kept row, copies (rows) and variants (distinct spellings)."""
        columns = [F.col(f"record.{c}").alias(c) for c in [*self.texts, *self.sets]]
        return self.groups.select(F.col("kept").alias(f"{self.id}_kept"), *columns, "copies", "variants")

    def members(self) -> DataFrame:
        """id_kept, id_copy: every row but the kept one of its group, with the kept id."""
        several = self.groups.where("copies > 1")
        # groups were made on the full text; from here its digest stands for it, so keys are short however long texts are
        key = F.unhex(F.sha2("canonical", 256)).alias("key")
        lookup = attach(self.survivors.select("digest", key, "n"), several.select(key, "variants", "kept"), "key", "variants", self.distinct, ["kept"]).select("digest", "kept", "n")
        rows = self.df.select(F.col(self.id).alias("_copy"), self._digest().alias("digest"))
        found = attach(rows, materialise(lookup), "digest", "n", self.rows, ["kept"])
        return found.where("kept <> _copy").select(F.col("kept").alias(f"{self.id}_kept"), F.col("_copy").alias(f"{self.id}_copy"))
