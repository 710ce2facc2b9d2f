"""Streaming counterparts, an extension: windows and sessions over a stream of events, and an idempotent sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.sinks import replace_scope


def read(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """A stream over the Parquet files of a folder; the time column becomes a timestamp, as watermarks need."""
    schema = spark.read.parquet(path).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def tumbling(events: DataFrame, size: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Events and their value per window and type; what comes later than `late` is dropped by the watermark."""
    grouped = events.withWatermark("ts", late).groupBy(F.window("ts", size), "event_type")
    return grouped.agg(F.count("*").alias("events"), F.sum(F.col("value").cast("decimal(18,4)")).alias("total")).select(F.col("window.start").alias("window_start"), "event_type", "events", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 day") -> DataFrame:
    """Sessions of each user, parted by silence of `gap`."""
    grouped = events.withWatermark("ts", late).groupBy("user_id", F.session_window("ts", gap))
    return grouped.agg(F.count("*").alias("events")).select("user_id", F.col("session_window.start").alias("session_start"), F.col("session_window.end").alias("session_end"), "events")


def write_idempotent(stream: DataFrame, path: str, scope: str, checkpoint: str):
    """Each micro-batch rewrites the partitions it holds, so a batch run twice leaves one copy."""
    return stream.writeStream.foreachBatch(lambda batch, _: replace_scope(batch, path, scope)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
