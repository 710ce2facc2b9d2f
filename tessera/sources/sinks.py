"""Sinks: replace one scope, merge by key, and small human-readable reports."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def replace_scope(df: DataFrame, path: str, scope: str) -> None:
    """Rewrite the partitions of `scope` that df holds and leave the others: one release at a time, idempotent."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(scope).parquet(path)


def swap(df: DataFrame, path: str, version: str) -> str:
    """Write a new version of a table beside the old ones; a reader takes the folder this returns."""
    target = f"{path}/version={version}"
    df.write.mode("errorifexists").parquet(target)
    return target


def markdown(df: DataFrame, most: int = 400, plain: Sequence[str] = ()) -> str:
    """A Markdown table of at most `most` rows; whole numbers get thousands separators except in the columns named plain and in years."""
    def cell(name: str, value) -> str:
        if value is None:
            return ""
        if isinstance(value, int) and not isinstance(value, bool) and name not in plain and not name.endswith("year"):
            return f"{value:,}"
        return str(value).replace("|", "\\|")

    rows = df.limit(most).collect()
    lines = ["| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
    return "\n".join([*lines, *("| " + " | ".join(cell(c, r[c]) for c in df.columns) + " |" for r in rows)])


def _one_file(lines: DataFrame, path: str) -> None:
    """The text lines of a report, in the order of their rows, as one file of the folder; reports are of bounded size."""
    lines.coalesce(1).write.mode("overwrite").option("lineSep", "\n").text(path)


def csv_with_bom(df: DataFrame, path: str, most: int | None = None, rows: int = 1_000_000) -> None:
    """CSV for spreadsheets, every row of it: files of at most `rows` rows (a spreadsheet holds 1,048,576), each with a byte order mark and the header; by name, then line, they have the caller's order. Refused beyond `most` rows if that is given."""
    n = df.count()
    if most is not None and n > most:
        raise ValueError(f"a report of more than {most} rows; write a table instead")

    def quoted(c: str) -> Column:
        text = F.coalesce(F.col(c).cast("string"), F.lit(""))
        return F.when(text.rlike('[",\r\n]'), F.concat(F.lit('"'), F.regexp_replace(text, '"', '""'), F.lit('"'))).otherwise(text)

    head = "\ufeff" + ",".join('"' + c.replace('"', '""') + '"' if set(c) & set('",\r\n') else c for c in df.columns)
    if not n:
        return _one_file(df.sparkSession.range(1).select(F.lit(head).alias("value")), path)
    at, names = F.monotonically_increasing_id(), [f"c{k}" for k in range(len(df.columns))]
    parts = df.toDF(*names).withColumn("at", at).repartitionByRange(-(-n // rows), "at").sortWithinPartitions("at")  # quoted afterwards, as finding the ranges runs what comes before
    line, first = F.concat_ws(",", *map(quoted, names)), at.bitwiseAND((1 << 33) - 1) % rows == 0  # the lower 33 bits count a task's rows
    text = parts.select(F.concat(F.when(first, F.lit(head + "\n")).otherwise(""), line).alias("value"))  # the header in one value with a file's first row: nothing can come before it
    text.write.mode("overwrite").option("lineSep", "\n").option("maxRecordsPerFile", rows).text(path)


def json_lines(df: DataFrame, path: str) -> None:
    """One JSON object a row, in as many files as df has partitions; nulls are left out."""
    df.write.mode("overwrite").json(path)


def sitemap(urls: DataFrame, path: str, url: str = "url", changed: str | None = None) -> None:
    """A sitemap of the distinct urls, in order, as one file of the folder."""
    escaped = lambda c: F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "&", "&amp;"), "<", "&lt;"), ">", "&gt;")
    day = F.concat(F.lit("<lastmod>"), F.date_format(F.max(changed), "yyyy-MM-dd"), F.lit("</lastmod>")) if changed else F.lit("")
    entries = urls.where(F.col(url).isNotNull()).groupBy(escaped(F.col(url)).alias("u")).agg(F.coalesce(day, F.lit("")).alias("d"))
    wrap = urls.sparkSession.createDataFrame
    numbered = entries.select(F.lit(1).alias("k"), "u", F.concat(F.lit("<url><loc>"), F.col("u"), F.lit("</loc>"), F.col("d"), F.lit("</url>")).alias("value"))
    ends = wrap([(0, "", '<?xml version="1.0" encoding="UTF-8"?>\n<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'), (2, "", "</urlset>")], "k int, u string, value string")
    _one_file(numbered.unionByName(ends).orderBy("k", "u").select("value"), path)


def event(kind: str, **facts: object) -> str:
    """A structured event as one line of JSON, keys in order."""
    return json.dumps({"event": kind, **facts}, ensure_ascii=False, sort_keys=True, default=str)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header and perhaps a byte order mark, by an explicit schema."""
    return spark.read.schema(schema).option("header", "true").option("enforceSchema", "true").option("multiLine", "true").option("quote", '"').option("escape", '"').csv(path)
