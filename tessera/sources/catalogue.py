"""The catalogue's JSON files: scanned by an explicit schema, shaped, and checked for what a link audit should probe."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from urllib.parse import parse_qs, urlencode

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SCHEMA = "id string, country string, topic string, name string, url string, `desc` string, kind string, access string, data string, verified date, check string, native string"


def read(spark: SparkSession, path: str) -> DataFrame:
    """Items of all files at path, each a JSON list, with file, the name of the file an item stands in."""
    return spark.read.schema(SCHEMA).json(path, multiLine=True).withColumn("file", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)).select(*[F.col(c.split()[0]) for c in SCHEMA.split(", ")], "file")


def ordered(items: DataFrame, topics: DataFrame, places: DataFrame) -> DataFrame:
    """items in catalogue order with `place`: group, topic and place by their stated order, then id within the file.

    topics: (topic, group_order, topic_order); places: (country, place_order); both vocabularies. Unknown ones come last.
    """
    joined = items.join(topics, "topic", "left").join(places, "country", "left")
    w = Window.partitionBy("topic").orderBy(F.asc_nulls_last("place_order"), "country", "file", "id")
    return joined.withColumn("place", F.row_number().over(w))


def shaped(items: DataFrame, topics: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(topics, edges) without those no item uses, topics with stable ordinals from 0."""
    used = topics.join(items.select("topic").distinct(), "topic", "left_semi")
    # the vocabulary is one small table, so its order can come from one window
    numbered = used.withColumn("ordinal", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("topic")) - 1)
    kept = edges.join(used.select("topic"), "topic", "left_semi").join(used.select(F.col("topic").alias("related")), "related", "left_semi")
    return numbered, kept.select("topic", "related")


def probe_targets(items: DataFrame, countries: Sequence[str] = (), topics: Sequence[str] = (), ids: Sequence[str] = (), changed_since: DataFrame | None = None) -> DataFrame:
    """Items whose links an audit should probe; with changed_since, those whose URL isn't the one there. An empty selection is an error unless only changes were asked for."""
    chosen = items.where(F.col("url").isNotNull())
    for column, values in (("country", countries), ("topic", topics), ("id", ids)):
        if values:
            chosen = chosen.where(F.col(column).isin(*values))
    if changed_since is not None:
        return chosen.join(changed_since.select("id", "url"), ["id", "url"], "left_anti")
    if chosen.limit(1).count() == 0:
        raise ValueError("nothing to probe")
    return chosen


def read_state(text: str, known: Mapping[str, Collection[str]]) -> dict[str, str | int]:
    """A query's state from its text form: q, page and the axes in known; unknown axes and values are dropped, page is at least 1."""
    given = {k: v[-1] for k, v in parse_qs(text.lstrip("#?")).items()}
    state: dict[str, str | int] = {k: v for k, v in given.items() if k in known and v in known[k]}
    if given.get("q", "").strip():
        state["q"] = given["q"].strip()
    page = given.get("page", "1")
    state["page"] = max(1, int(page)) if page.isdigit() else 1
    return state


def write_state(state: Mapping[str, str | int]) -> str:
    """The text form of a state; page 1 is left out."""
    return urlencode({k: v for k, v in sorted(state.items()) if not (k == "page" and v == 1)})
