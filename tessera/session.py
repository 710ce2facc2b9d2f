"""Session settings, table loading and durable intermediate results."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(app: str = "tessera", master: str | None = None, **conf: str) -> SparkSession:
    """A session with this library's defaults; on a cluster leave master unset."""
    builder = SparkSession.builder.appName(app).config(map=DEFAULTS | conf)
    if master:
        builder = builder.master(master)
    return builder.getOrCreate()


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers of a session, once: they needn't have it installed or on their path."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="tessera-code-"), "tessera_code.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(here):
            for name in sorted(f for f in files if f.endswith(".py")):
                path = os.path.join(folder, name)
                z.write(path, os.path.relpath(path, os.path.dirname(here)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """Parquet table `name` of a data directory; only the columns used later are read."""
    return spark.read.parquet(f"{directory}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary folder only where none is named and all runs in one process (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", "")
    if not found:
        jvm_dir = spark.sparkContext._jsc.sc().getCheckpointDir()
        found = jvm_dir.get() if jvm_dir.isDefined() else ""
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        found = tempfile.mkdtemp(prefix="tessera-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def materialise(df: DataFrame) -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends there and lost executors cost nothing.

    All tables of one application lie in one folder there, to be removed when the application is over.
    """
    path = f"{checkpoint_dir(df.sparkSession)}/tessera-{df.sparkSession.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, most: int, what: str) -> list:
    """Rows of a table whose size is bounded by contract; raises beyond `most` rows instead of collecting them."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"{what} has more than {most} rows; it must be a bounded reference table")
    return rows
