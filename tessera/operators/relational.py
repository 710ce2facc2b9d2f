"""Joins, merges and choices that the query layer shares, declared with built-in operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.temporal import overlaps


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in an order; planned as a window group limit, so all but one row of a key leave before the shuffle.

    The order must end in a unique column for the result to be determined. Null keys form a group.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def merge_upsert(existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """existing with incoming merged in: incoming rows replace rows of the same key, null-safe; keys must be unique on each side."""
    matched = reduce(lambda a, b: a & b, (F.col(f"e.{k}").eqNullSafe(F.col(f"i.{k}")) for k in keys))
    e, i = existing.withColumn("_there", F.lit(True)).alias("e"), incoming.withColumn("_there", F.lit(True)).alias("i")
    columns = existing.columns
    return e.join(i, matched, "full").select(*(F.when(F.col("i._there"), F.col(f"i.{c}")).otherwise(F.col(f"e.{c}")).alias(c) for c in columns))


def insert_new(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """existing and the first incoming row of each key that isn't there yet."""
    return existing.unionByName(first_by(incoming, keys, order).join(existing.select(*keys), list(keys), "left_anti"))


def modal(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """The most frequent value of each key with its uses; ties go to the longest, then the first in alphabetical order."""
    counted = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("uses"))
    return first_by(counted, keys, [F.desc("uses"), F.length(value).desc(), F.asc(value)])


def overlap_join(left: DataFrame, right: DataFrame, on: Sequence[str], left_range: tuple[str, str], right_range: tuple[str, str], how: str = "inner") -> DataFrame:
    """Join on equal keys and overlapping half-open date ranges. Keys decide the exchange; the overlap is a residual."""
    l_, r = left.alias("l"), right.alias("r")
    same = reduce(lambda a, b: a & b, (F.col(f"l.{k}") == F.col(f"r.{k}") for k in on))
    return l_.join(r, same & overlaps(F.col(f"l.{left_range[0]}"), F.col(f"l.{left_range[1]}"), F.col(f"r.{right_range[0]}"), F.col(f"r.{right_range[1]}")), how)


def prefix_join(deep: DataFrame, roots: DataFrame, domain: str, deep_path: str, root_path: str) -> DataFrame:
    """Rows whose path equals or lies under a root's path on the same domain; an empty root path covers the domain."""
    d, r = deep.alias("d"), roots.alias("r")
    under = (F.col(f"r.{root_path}") == "") | (F.col(f"d.{deep_path}") == F.col(f"r.{root_path}")) | F.col(f"d.{deep_path}").startswith(F.concat(F.col(f"r.{root_path}"), F.lit("/")))
    return d.join(r, (F.col(f"d.{domain}") == F.col(f"r.{domain}")) & under)


def tiered(df: DataFrame, tiers: Sequence[tuple[str, DataFrame]], key: str, found: str) -> DataFrame:
    """df with `found`, `tier` and `matches`: the first tier that knows the key decides; one match is accepted, more are ambiguous and give null.

    Each tier is (name, table of (key, found)). Every tier costs one join on the key.
    """
    out = df
    for n, (_, table) in enumerate(tiers):
        counted = table.where(F.col(key).isNotNull()).groupBy(key).agg(F.count_distinct(found).alias(f"_n{n}"), F.min(found).alias(f"_f{n}"))
        out = out.join(counted, key, "left")
    hits = [F.col(f"_n{n}") for n in range(len(tiers))]
    pick = lambda values: reduce(lambda w, k: w.when(hits[k].isNotNull(), values[k]), range(1, len(tiers)), F.when(hits[0].isNotNull(), values[0]))
    matches = F.coalesce(pick(hits), F.lit(0))
    out = out.withColumns({"matches": matches, "tier": pick([F.lit(name) for name, _ in tiers]), found: pick([F.col(f"_f{n}") for n in range(len(tiers))])})
    out = out.withColumn(found, F.when(F.col("matches") == 1, F.col(found)))
    return out.drop(*[c for n in range(len(tiers)) for c in (f"_n{n}", f"_f{n}")])


def missing_reverse(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Edges whose reverse isn't there."""
    return edges.join(edges.select(F.col(a).alias(b), F.col(b).alias(a)), [a, b], "left_anti")


def page(df: DataFrame, order: Sequence[Column], number: int, size: int = 50) -> DataFrame:
    """Page `number` (from 1, clamped below) of an ordered result."""
    start = (max(1, number) - 1) * size
    return df.orderBy(*order).offset(start).limit(size)
