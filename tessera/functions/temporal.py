"""Half-open date ranges as two columns; a null bound is unbounded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _first(day: Column | str) -> Column:
    """A start, with the first day there is where it is unbounded."""
    return F.coalesce(day, F.lit("0001-01-01").cast("date"))


def _last(day: Column | str) -> Column:
    return F.coalesce(day, F.lit("9999-12-31").cast("date"))


def overlaps(a_from: Column, a_to: Column, b_from: Column, b_to: Column) -> Column:
    """Whether [a_from, a_to) and [b_from, b_to) share a day."""
    return (_first(a_from) < _last(b_to)) & (_first(b_from) < _last(a_to))


def holds(start: Column, end: Column, day: Column) -> Column:
    """Whether [start, end) holds a day."""
    return (_first(start) <= day) & (day < _last(end))


def year_period(reference_year: Column, edition_year: Column) -> Column:
    """(start, end, precision): the stated year, or the edition's with precision unknown."""
    year = F.coalesce(reference_year, edition_year)
    return F.struct(F.make_date(year, F.lit(1), F.lit(1)).alias("start"), F.make_date(year + 1, F.lit(1), F.lit(1)).alias("end"), F.when(reference_year.isNotNull(), "year").otherwise("unknown").alias("precision"))


def overlap_violations(df: DataFrame, key: list[str], start: str, end: str, order: list[str]) -> DataFrame:
    """Rows whose range overlaps that of an earlier row of the same key: a sweep over running ends, no self-join.

    Null starts are unbounded and come first. Rows with a null key are never violations.
    """
    w = Window.partitionBy(*key).orderBy(_first(start), *order).rowsBetween(Window.unboundedPreceding, -1)
    swept = df.dropna(subset=key).withColumn("_reach", F.max(_last(end)).over(w))
    return swept.where(_first(start) < F.col("_reach")).drop("_reach")
