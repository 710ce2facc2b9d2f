"""Manifests of artifacts: read, validated and selected as tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = (
    "schema_version int, dataset struct<code:string,title:string,publisher:struct<code:string,name:string>,license:struct<basis:string,statement:string>>, "
    "editions array<struct<edition_year:int,edition_label:string,artifacts:array<struct<artifact_id:string,filename:string,media_type:string,compression:string,size_bytes:bigint,sha256:string,checksum_origin:string,parser_family:string,role:string,"
    "retrievals:array<struct<priority:int,role:string,url:string,byte_stable:boolean>>>>>>"
)


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row per artifact of the manifests at path, with its data set, edition and retrievals."""
    docs = spark.read.schema(SCHEMA).json(path, multiLine=True)
    editions = docs.select("schema_version", F.col("dataset.code").alias("dataset_code"), F.explode_outer("editions").alias("e"))
    artifacts = editions.select("schema_version", "dataset_code", "e.edition_year", "e.edition_label", F.explode_outer("e.artifacts").alias("a"))
    return artifacts.select("schema_version", "dataset_code", "edition_year", "edition_label", "a.*")


def faults(artifacts: DataFrame) -> DataFrame:
    """artifact_id, rule of every broken rule of a manifest."""
    stable = F.exists("retrievals", lambda r: F.coalesce(r.byte_stable, F.lit(False)) & F.coalesce(r.url.startswith("https://"), F.lit(False)))
    located = F.forall("retrievals", lambda r: F.coalesce(r.url.startswith("https://"), F.lit(False)))
    rules = {
        "unsupported_schema_version": F.col("schema_version") != 1, "sha256_not_64_hex": ~F.coalesce(F.col("sha256").rlike("^[0-9a-f]{64}$"), F.lit(False)), "size_not_positive": ~F.coalesce(F.col("size_bytes") > 0, F.lit(False)),
        "no_byte_stable_https_retrieval": ~F.coalesce(stable, F.lit(False)), "retrieval_not_https": ~F.coalesce(located, F.lit(True)),
    }
    single = artifacts.select("artifact_id", F.explode(F.array_compact(F.array(*(F.when(bad, name) for name, bad in rules.items())))).alias("rule"))
    repeated = artifacts.groupBy("artifact_id").agg(F.count("*").alias("n")).where("n > 1").select("artifact_id", F.lit("artifact_id_repeated").alias("rule"))
    sizes = artifacts.groupBy("sha256").agg(F.count_distinct("size_bytes").alias("n"), F.min("artifact_id").alias("artifact_id")).where("n > 1").select("artifact_id", F.lit("digest_with_two_sizes").alias("rule"))
    return single.unionByName(repeated).unionByName(sizes)


def select(artifacts: DataFrame, years: Sequence[int] = (), families: Sequence[str] = (), ids: Sequence = (), ingestable: Sequence[str] = (), everything: bool = False) -> DataFrame:
    """Artifacts that meet all filters given. No filter at all is refused unless everything is asked for."""
    if not (years or families or ids or everything):
        raise ValueError("select by years, families or ids, or ask for everything")
    kept: Column = F.lit(True)
    for column, values in (("edition_year", years), ("parser_family", families), ("artifact_id", ids), ("parser_family", ingestable)):
        if values:
            kept = kept & F.col(column).isin(*values)
    return artifacts.where(kept)


def stored_at(folder: str) -> Column:
    """Where an artifact's bytes lie: by digest, then name."""
    return F.concat_ws("/", F.lit(folder.rstrip("/")), "sha256", "filename")
