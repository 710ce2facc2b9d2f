"""Scans and sinks over files: tables are written as files of each kind to the shared folder and read back by the scans."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from ..session import table as t
from ..sources import catalogue, entries, manifest, sinks

c = F.col


def _folder(s: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(s)}/tessera-{s.sparkContext.applicationId}/files-{name}-{uuid.uuid4().hex}"


def _written(texts: DataFrame, name: str, key: str | None = None) -> str:
    """Texts (value, and the key that parts them into files) as text files; the folder."""
    path = _folder(texts.sparkSession, name)
    writer = texts.write.partitionBy(key) if key else texts.write
    writer.text(path, lineSep="\n")
    return path


def text_entries(s: SparkSession, d: str) -> DataFrame:
    """Customers as a text with section markers, bare headings, labels, subfields and wrapped lines, read back. #7, #9, #10, #87"""
    cu = t(s, d, "customer").select("c_custkey", "c_name", "c_mktsegment", c("c_acctbal").cast("string").alias("bal"), "c_nationkey")
    lines = F.concat(
        F.lit("@"), c("c_name"), F.lit(":Economy\nBalance: total: "), c("bal"), F.lit("\nMarket:\n  segment: "), c("c_mktsegment"), F.lit("\n  wrapped line\n\nGovernment\nNation: "), c("c_nationkey").cast("string"), F.lit("\n======\nAppendix A: gone"),
    )
    found = entries.scan(s, _written(cu.select(lines.alias("value")), "text"), "text_era")
    return found.select("source_key", "section_name", "field_name", "subfield_name", "ordinal", "raw_text", "error_code")


def json_entries(s: SparkSession, d: str) -> DataFrame:
    """Nations as JSON entries of categories, fields and subfields, read back. #12"""
    n = t(s, d, "nation").select("n_nationkey", "n_name", "n_regionkey")
    doc = F.to_json(F.struct(
        c("n_name").alias("name"), F.concat(F.lit("N"), c("n_nationkey").cast("string")).alias("code"), c("n_regionkey").cast("string").alias("region"),
        F.array(F.struct(F.lit("Geography").alias("title"), F.array(F.struct(F.lit("Area").alias("name"), F.concat(F.lit("<b>"), c("n_nationkey").cast("string"), F.lit("</b> km &amp; more")).alias("content"))).alias("fields"))).alias("categories"),
    ))
    found = entries.scan(s, _written(n.select("n_nationkey", doc.alias("value")), "json", "n_nationkey"), "json_cache")
    return found.select("source_key", "source_name", "section_name", "field_name", "raw_text")


def html_entries(s: SparkSession, d: str) -> DataFrame:
    """Nations as pages in three layouts, a redirect and an unknown one, read back. #8, #11"""
    n = t(s, d, "nation").select("n_nationkey", "n_name")
    head = F.concat(F.lit("<html><head><title>Pages -- "), c("n_name"), F.lit("</title></head><body>"))
    key = c("n_nationkey").cast("string")
    page = (
        F.when(c("n_nationkey") % 5 == 0, F.concat(head, F.lit('<table><tr><td class="FieldLabel">Area:</td><td><i>total:</i> '), key, F.lit(" km</td></tr></table></body></html>")))
        .when(c("n_nationkey") % 5 == 1, F.concat(head, F.lit('<div id="field">Area:</div><div class="category_data">'), key, F.lit(" km</div></body></html>")))
        .when(c("n_nationkey") % 5 == 2, F.concat(head, F.lit('<div id="field-anchor-geography-area"><a href="x">Area</a>:<div id="field-area"><span class="subfield-name">total:</span> '), key, F.lit(" km</div></div></body></html>")))
        .when(c("n_nationkey") % 5 == 3, F.concat(F.lit('<html><head><meta http-equiv="refresh" content="0;url=x.html"><title>Pages -- '), c("n_name"), F.lit("</title></head></html>")))
        .otherwise(F.concat(head, F.lit("<p>"), key, F.lit("</p></body></html>")))
    )
    found = entries.scan(s, _written(n.select("n_nationkey", page.alias("value")), "html", "n_nationkey"), "html_pages")
    return found.select("source_name", "section_name", "field_name", "subfield_name", F.when(c("error_code").isNull(), c("raw_text")).alias("raw_text"), "error_code")


def file_digests(s: SparkSession, d: str) -> DataFrame:
    """Size and SHA-256 of the bytes of a file for each nation. #5"""
    n = t(s, d, "nation").select("n_nationkey", c("n_name").alias("value"))
    return entries.digests(s, _written(n, "bytes", "n_nationkey")).select("size_bytes", "sha256")


def manifest_artifacts(s: SparkSession, d: str) -> DataFrame:
    """Nations as a manifest: artifacts with their place by digest and the rules they break. #1, #2, #6"""
    n = t(s, d, "nation").select("n_nationkey", "n_regionkey", "n_name")
    artifact = F.struct(
        F.concat(F.lit("a"), c("n_nationkey").cast("string")).alias("artifact_id"), F.concat(c("n_name"), F.lit(".txt")).alias("filename"), (c("n_nationkey") % 7).cast("long").alias("size_bytes"),
        F.sha2("n_name", 256).alias("sha256"), F.lit("text_era").alias("parser_family"),
        F.array(F.struct(F.lit(1).alias("priority"), F.when(c("n_nationkey") % 4 == 0, "http://x.example/a").otherwise("https://x.example/a").alias("url"), F.lit(True).alias("byte_stable"))).alias("retrievals"),
    )
    years = n.groupBy((c("n_regionkey") + 2000).alias("edition_year")).agg(F.array_sort(F.collect_list(artifact)).alias("artifacts"))  # at most a manifest's artifacts
    doc = years.agg(F.array_sort(F.collect_list(F.struct("edition_year", "artifacts"))).alias("editions")).select(F.to_json(F.struct(F.lit(1).alias("schema_version"), F.struct(F.lit("nations").alias("code")).alias("dataset"), "editions")).alias("value"))
    a = manifest.read(s, _written(doc.coalesce(1), "manifest"))
    faults = manifest.faults(a).groupBy("artifact_id").agg(F.array_join(F.array_sort(F.collect_set("rule")), ",").alias("rules"))
    placed = a.select("artifact_id", "edition_year", manifest.stored_at("/raw/").alias("place"))
    return placed.join(faults, "artifact_id", "left").select("artifact_id", "edition_year", "place", F.coalesce("rules", F.lit("")).alias("rules"))


def catalogue_files(s: SparkSession, d: str) -> DataFrame:
    """Nations as lists of JSON items, one file a region, read by the catalogue's schema. #13"""
    n = t(s, d, "nation").select("n_nationkey", "n_name", "n_regionkey")
    item = F.struct(c("n_nationkey").cast("string").alias("id"), c("n_regionkey").cast("string").alias("country"), F.lit("water").alias("topic"), c("n_name").alias("name"), F.lit("2020-01-02").alias("verified"))
    lists = n.groupBy("n_regionkey").agg(F.to_json(F.collect_list(item)).alias("value"))  # 25 nations at every scale
    return catalogue.read(s, _written(lists, "catalogue", "n_regionkey")).select("id", "country", "topic", "name", "verified", "url")


def csv_round_trip(s: SparkSession, d: str) -> DataFrame:
    """Parts as a CSV report with a byte order mark, read back. #14, #20"""
    path = _folder(s, "csv")
    sinks.csv_with_bom(t(s, d, "part").select("p_partkey", F.concat(c("p_name"), F.lit(', "x"')).alias("name"), F.when(c("p_size") > 9, c("p_size")).alias("size")), path)
    return sinks.read_csv(s, path, "p_partkey long, name string, size int")


def replaced_scope(s: SparkSession, d: str) -> DataFrame:
    """Nations by region, of which one region is written again: only that one changes. #18"""
    path = _folder(s, "scope")
    n = t(s, d, "nation").select("n_nationkey", "n_name", "n_regionkey")
    sinks.replace_scope(n, path, "n_regionkey")
    sinks.replace_scope(n.where("n_regionkey = 2 and n_nationkey % 2 = 0").withColumn("n_name", F.lower("n_name")), path, "n_regionkey")
    return s.read.parquet(path).select("n_nationkey", "n_name", c("n_regionkey").cast("int").alias("n_regionkey"))


NAMES = (text_entries, json_entries, html_entries, file_digests, manifest_artifacts, catalogue_files, csv_round_trip, replaced_scope)
QUERIES = {f.__name__: f for f in NAMES}
_TEXT = "SELECT lower(c_name) AS source_key, {0} AS section_name, {1} AS field_name, {2} AS subfield_name, {3} AS ordinal, {4} AS raw_text, CAST(NULL AS VARCHAR) AS error_code FROM customer"
SQL = {
    "text_entries": " UNION ALL ".join((
        _TEXT.format("'Economy'", "'Balance'", "''", 0, "'total: ' || CAST(c_acctbal AS VARCHAR)"),
        _TEXT.format("'Economy'", "'Market'", "'segment'", 1, "c_mktsegment || ' wrapped line'"),
        _TEXT.format("'Government'", "'Nation'", "''", 2, "CAST(c_nationkey AS VARCHAR)"),
    )),
    "json_entries": "SELECT 'n' || n_nationkey AS source_key, n_name AS source_name, '_document' AS section_name, 'region' AS field_name, CAST(n_regionkey AS VARCHAR) AS raw_text FROM nation UNION ALL SELECT 'n' || n_nationkey, n_name, 'Geography', 'Area', n_nationkey || ' km & more' FROM nation",
    "html_entries": """SELECT n_name AS source_name, CASE k WHEN 2 THEN 'Geography' WHEN 0 THEN '' WHEN 1 THEN '' END AS section_name, CASE WHEN k < 3 THEN 'Area' END AS field_name, CASE k WHEN 1 THEN '' WHEN 0 THEN 'total' WHEN 2 THEN 'total' END AS subfield_name,
  CASE WHEN k < 3 THEN n_nationkey || ' km' END AS raw_text, CASE k WHEN 3 THEN 'html_redirect_stub' WHEN 4 THEN 'html_layout_unknown' END AS error_code FROM (SELECT *, n_nationkey % 5 AS k FROM nation)""",
    "file_digests": "SELECT CAST(length(n_name) + 1 AS BIGINT) AS size_bytes, sha256(n_name || chr(10)) AS sha256 FROM nation",
    "manifest_artifacts": """SELECT 'a' || n_nationkey AS artifact_id, CAST(n_regionkey + 2000 AS INT) AS edition_year, '/raw/' || sha256(n_name) || '/' || n_name || '.txt' AS place,
  concat_ws(',', CASE WHEN n_nationkey % 4 = 0 THEN 'no_byte_stable_https_retrieval' END, CASE WHEN n_nationkey % 4 = 0 THEN 'retrieval_not_https' END, CASE WHEN n_nationkey % 7 = 0 THEN 'size_not_positive' END) AS rules FROM nation""",
    "catalogue_files": "SELECT CAST(n_nationkey AS VARCHAR) AS id, CAST(n_regionkey AS VARCHAR) AS country, 'water' AS topic, n_name AS name, DATE '2020-01-02' AS verified, CAST(NULL AS VARCHAR) AS url FROM nation",
    "csv_round_trip": "SELECT p_partkey, p_name || ', \"x\"' AS name, CASE WHEN p_size > 9 THEN p_size END AS size FROM part",
    "replaced_scope": "SELECT n_nationkey, CASE WHEN n_regionkey = 2 THEN lower(n_name) ELSE n_name END AS n_name, n_regionkey FROM nation WHERE n_regionkey <> 2 OR n_nationkey % 2 = 0",
}
