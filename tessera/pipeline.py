"""The thin API over the operators: stage files, load claims, build the mart, run quality, report."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import load as loading
from .operators import mart, quality
from .operators.relational import merge_upsert
from .session import materialise
from .sources import entries, manifest, sinks

FAMILIES = tuple(entries.READERS)


def register(spark: SparkSession, manifests: str, registry: str) -> DataFrame:
    """Artifacts of the manifests merged into a new version of the registry table; a manifest with faults is refused whole."""
    incoming = manifest.read(spark, manifests)
    found = [f"{r.artifact_id}: {r.rule}" for r in manifest.faults(incoming).orderBy("artifact_id", "rule").limit(20).collect()]
    if found:
        raise ValueError("manifest refused: " + "; ".join(found))
    flat, version = incoming.drop("retrievals"), 1
    try:
        every = spark.read.parquet(registry)
        newest = every.agg(F.max("version")).first()[0]
        flat, version = merge_upsert(every.where(F.col("version") == newest).drop("version"), flat, ["artifact_id"]), newest + 1
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    # a version once written is never touched again, so whoever reads the one before isn't disturbed
    return spark.read.parquet(sinks.swap(flat, registry, str(version)))


def stage(spark: SparkSession, artifacts: DataFrame, raw: str, bronze: str, quarantine: str) -> None:
    """Parse the stored bytes of artifacts into bronze, one partition per artifact; failures go to the quarantine.

    Staging an artifact again replaces its partition. Digests are verified first: bytes that aren't those the manifest
    names are quarantined, not parsed. One bad file never stops the others.
    """
    stored = artifacts.where(F.col("parser_family").isin(*FAMILIES)).select("artifact_id", "parser_family", "sha256", "edition_year", "dataset_code")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(raw)
    named = files.withColumn("sha256", F.element_at(F.split("path", "/"), -2))
    # only the files that are wanted are opened, each once; the list of wanted digests is narrow and Spark broadcasts it while it is small
    wanted = named.join(stored.select("sha256", F.col("parser_family").alias("family")).distinct(), "sha256")
    rows = materialise(entries.parse_named(wanted)).withColumnRenamed("family", "parser_family").join(stored, ["sha256", "parser_family"])
    fields = rows.where("error_code is null").drop("error_code", "reason", "sha256")
    absent = stored.join(named.select("sha256"), "sha256", "left_anti").select("artifact_id", F.lit(None).cast("string").alias("file"), F.lit("artifact_not_stored").alias("error_code"), F.lit("no bytes at the digest's place").alias("reason"))
    failures = rows.where("error_code is not null").select("artifact_id", "file", "error_code", "reason").unionByName(absent)
    sinks.replace_scope(fields, bronze, "artifact_id")
    sinks.replace_scope(failures, quarantine, "artifact_id")


def load(spark: SparkSession, bronze: str, mapping: DataFrame, silver: str) -> dict[str, int]:
    """Typed claims of bronze fields, each kind a table of silver; rows written by table."""
    staged = spark.read.parquet(bronze)
    key = F.sha2(F.to_json(F.struct("artifact_id", "member", "source_key", "section_name", "field_name", "subfield_name", "ordinal", "raw_text")), 256)
    out = loading.load(staged.withColumn("field_value_id", key), mapping)
    tables = {"observation": out.observations, "composition": out.members, "bilateral": out.partners, "point": out.points, "narrative": out.narratives, "rejected": out.rejected}
    return mart.refresh(tables, silver)


def reconcile(spark: SparkSession, bronze: str, reported: DataFrame) -> DataFrame:
    """Artifacts whose staged rows differ in number from those reported (artifact_id, n)."""
    return quality.reconcile(reported, spark.read.parquet(bronze).groupBy("artifact_id").agg(F.count("*").alias("n")), "artifact_id")


def report(df: DataFrame, most: int = 400) -> str:
    """A table for people."""
    return sinks.markdown(df, most)
