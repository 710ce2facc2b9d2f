"""Quality checks: each a query that gives findings, a true total and a bounded sample; gates that refuse a release."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialise

SEVERITIES = ("info", "warning", "error")
#: Example keys kept beside each check's true total.
SAMPLE = 5


@dataclass(frozen=True)
class Check:
    """A check: the rows it finds fault with, one string key each."""

    name: str
    severity: str
    faults: DataFrame
    key: Column
    gate: bool = False


def run(checks: list[Check], sample: int = SAMPLE) -> DataFrame:
    """check_name, severity, gate, findings, sample: one row per check, those without faults included.

    Every check is evaluated once: the keys of its faults go to one narrow table in the shared folder, from which totals
    and samples come. The sample is the least keys, so it is the same at every run; it is a top-k that never holds more
    than `sample` keys of a check.
    """
    spark = checks[0].faults.sparkSession
    keys = materialise(reduce(DataFrame.unionByName, (c.faults.select(F.lit(c.name).alias("check_name"), c.key.cast("string").alias("k")) for c in checks)))
    listed = spark.createDataFrame([(c.name, c.severity, c.gate) for c in checks], "check_name string, severity string, gate boolean")
    totals = keys.groupBy("check_name").agg(F.count("*").alias("findings"))
    nth = F.row_number().over(Window.partitionBy("check_name").orderBy(F.asc_nulls_last("k")))
    least = keys.withColumn("_n", nth).where(F.col("_n") <= sample).groupBy("check_name").agg(F.array_join(F.array_sort(F.collect_list("k")), ",").alias("sample"))
    joined = listed.join(totals, "check_name", "left").join(least, "check_name", "left")
    return joined.select("check_name", "severity", "gate", F.coalesce("findings", F.lit(0)).alias("findings"), F.coalesce("sample", F.lit("")).alias("sample"))


def outside_range(values: DataFrame, bounds: DataFrame, on: str, value: str) -> DataFrame:
    """Rows whose value lies outside the range expected of its kind (bounds: `on`, low, high; a null bound is open)."""
    held = bounds.select(on, F.col("low").alias("_low"), F.col("high").alias("_high"))
    return values.join(held, on).where((F.col(value) < F.col("_low")) | (F.col(value) > F.col("_high"))).drop("_low", "_high")


def contradicts_unit(claims: DataFrame, value: str, is_percent: str, currency: str, unit: str) -> DataFrame:
    """Claims whose value doesn't go with what it is measured in: a percentage of a currency, or a whole number like a year (1990 to 2025) without unit."""
    v = F.col(value)
    year = (v == F.floor(v)) & v.between(1990, 2025) & F.col(unit).isNull() & F.col(currency).isNull() & ~F.coalesce(F.col(is_percent), F.lit(False))
    return claims.where((F.col(is_percent) & F.col(currency).isNotNull()) | year)


def coverage(rows: DataFrame, parsed: Column, name: str = "parser_coverage") -> DataFrame:
    """One info row: how many of the rows were parsed."""
    counts = rows.agg(F.count("*").alias("total"), F.count_if(parsed).alias("parsed"))
    return counts.select(F.lit(name).alias("check_name"), F.lit("info").alias("severity"), "parsed", "total", F.coalesce(F.round(F.try_divide(F.col("parsed"), F.col("total")), 6), F.lit(0.0)).alias("share"))


def changed_bytes(stored: DataFrame, declared: DataFrame, deep: bool = False) -> DataFrame:
    """Stored files (key, size_bytes, sha256) that aren't what was declared: missing, of another size, or, if `deep`, of another digest."""
    d = declared.select("key", F.col("size_bytes").alias("_size"), F.col("sha256").alias("_digest"))
    other = F.when(F.col("size_bytes").isNull(), "not_stored").when(F.col("size_bytes") != F.col("_size"), "size_differs")
    if deep:
        other = other.when(F.col("sha256") != F.col("_digest"), "digest_differs")
    return d.join(stored.select("key", "size_bytes", "sha256"), "key", "left").select("key", other.alias("fault")).where("fault is not null")


def undeclared(declared: list[str], checks: list[Check], spark: SparkSession) -> DataFrame:
    """check_name, state of each check that is declared but not implemented, or implemented but not declared."""
    names = {c.name for c in checks}
    rows = [(n, "declared_only") for n in declared if n not in names] + [(n, "implemented_only") for n in sorted(names - set(declared))]
    return spark.createDataFrame(rows, "check_name string, state string")


def severity_rank(severity: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, SEVERITIES)), severity)


def gate_failed(findings: DataFrame) -> DataFrame:
    """One row: whether any release gate of severity error has findings."""
    return findings.agg(F.coalesce(F.bool_or((F.col("severity") == "error") & F.col("gate") & (F.col("findings") > 0)), F.lit(False)).alias("refused"))


def violations(df: DataFrame, rules: dict[str, Column], key: Column) -> DataFrame:
    """rule, key of each row that breaks a rule, in one pass; a rule that is null counts as kept."""
    broken = F.array_compact(F.array(*(F.when(~F.coalesce(ok, F.lit(True)), name) for name, ok in rules.items())))
    return df.select(F.explode(broken).alias("rule"), key.cast("string").alias("key"))


def not_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with how often."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).where("rows > 1")


def orphans(child: DataFrame, parent: DataFrame, on: list[str]) -> DataFrame:
    """Rows of child with a key that parent lacks; null keys refer to nothing and are no orphans."""
    return child.dropna(subset=on).join(parent.select(*on).distinct(), on, "left_anti")


def reconcile(reported: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    """key, reported, actual, difference where the numbers of two tables (key, n) differ; a missing side is 0."""
    joined = reported.select(key, F.col("n").alias("reported")).join(actual.select(key, F.col("n").alias("actual")), key, "full").na.fill(0, ["reported", "actual"])
    return joined.withColumn("difference", F.col("actual") - F.col("reported")).where("difference <> 0")
