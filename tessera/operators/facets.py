"""Faceted counts, coverage grids and rollups of a catalogue."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def facet_counts(items: DataFrame, axes: Sequence[str], filters: Mapping[str, Sequence[str]]) -> DataFrame:
    """axis, value, items: each axis counted under the filters of the other axes; values without items stay with 0.

    One pass: rows are exploded to (axis, value, matches), so the items are read once however many axes there are.
    """
    ok = {a: F.col(a).isin(*filters[a]) if filters.get(a) else F.lit(True) for a in axes}
    others = lambda a: reduce(lambda x, y: x & y, (F.coalesce(ok[b], F.lit(False)) for b in axes if b != a), F.lit(True))
    cells = F.array(*(F.struct(F.lit(a).alias("axis"), F.col(a).cast("string").alias("value"), others(a).cast("int").alias("hit")) for a in axes))
    return items.select(F.inline(cells)).where("value is not null").groupBy("axis", "value").agg(F.sum("hit").alias("items"))


def coverage_grid(items: DataFrame, row: str, column: str, values: Sequence[str]) -> DataFrame:
    """row × the listed column values, with `other` for the rest and `total`; holes are 0. The value list is explicit, so no extra pass finds it."""
    cell = F.when(F.col(column).isin(*values), F.col(column)).otherwise("other")
    grid = items.select(row, cell.alias("_c")).groupBy(row).pivot("_c", [*values, "other"]).count().na.fill(0)
    return grid.withColumn("total", reduce(lambda a, b: a + b, (F.col(f"`{v}`") for v in [*values, "other"])))


def rollup(items: DataFrame, by: str, member: str, shares: Mapping[str, Column]) -> DataFrame:
    """Per group: items, distinct members and the share of items that meet each condition."""
    return items.groupBy(by).agg(F.count("*").alias("items"), F.count_distinct(member).alias("members"), *(F.round(F.avg(c.cast("double")), 6).alias(n) for n, c in shares.items()))


def value_counts(items: DataFrame, column: str, position: str) -> DataFrame:
    """Counts of a column's values, most common first, ties by first occurrence."""
    return items.groupBy(column).agg(F.count("*").alias("items"), F.min(position).alias("first_seen")).orderBy(F.desc("items"), "first_seen")


def holes(rows: DataFrame, columns: DataFrame, filled: DataFrame, gaps: DataFrame, row: str, column: str) -> DataFrame:
    """Cells of a small grid that are neither filled nor a documented gap. rows and columns are lists of names, bounded by the catalogue's vocabulary."""
    grid = rows.select(row).distinct().crossJoin(F.broadcast(columns.select(column).distinct()))
    return grid.join(filled.select(row, column).distinct(), [row, column], "left_anti").join(gaps.select(row, column).distinct(), [row, column], "left_anti")


def classify(text: Column, classes: Sequence[tuple[str, str]], default: str) -> Column:
    """The first class whose pattern a text meets."""
    first, *rest = classes
    return reduce(lambda w, c: w.when(text.rlike(c[1]), c[0]), rest, F.when(text.rlike(first[1]), first[0])).otherwise(default)
