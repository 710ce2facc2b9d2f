"""From staged fields to typed claims: mapping, parsing, routing, quarantine."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import values as v
from ..session import small
from .relational import first_by

KINDS = ("observation", "composition", "bilateral", "coordinate", "narrative", "ignore")
#: The reference's cuts of stored texts, off by default (fixed values).
MOST_TEXT, MOST_RAW = 4000, 2000
NARRATIVE_LENGTH = 200
#: Rules a mapping may have.
MOST_RULES = 10_000


@dataclass
class Loaded:
    observations: DataFrame
    members: DataFrame
    partners: DataFrame
    points: DataFrame
    narratives: DataFrame
    rejected: DataFrame


def staged_once(fields: DataFrame) -> DataFrame:
    """Fields with rows staged more than once collapsed to the first staged: same record, path, ordinal and text."""
    keys = ["record_id", "section_name", "field_name", "subfield_name", "ordinal", "raw_text"]
    return first_by(fields, keys, [F.asc_nulls_last("staged_at"), F.asc("field_value_id")])


def dispatch(fields: DataFrame, mapping: DataFrame) -> DataFrame:
    """fields with target_kind and metric of their mapping, null where unmapped.

    mapping: (field_name, target_kind, metric, position), the last row of a name counts; an empty mapping is refused. It
    is a table of rules, at most MOST_RULES of them, checked; so it is broadcast, and fields never shuffle by their few names.
    """
    rows = small(mapping.select("field_name", "target_kind", "metric", "position"), MOST_RULES, "mapping")
    if not rows:
        raise ValueError("the mapping set is empty; loading would drop every field")
    rules = {r.field_name: (r.field_name, r.target_kind, r.metric) for r in sorted(rows, key=lambda r: r.position)}
    table = fields.sparkSession.createDataFrame(list(rules.values()), "field_name string, target_kind string, metric string")
    return fields.join(F.broadcast(table), "field_name", "left")


def load(fields: DataFrame, mapping: DataFrame, year: str = "edition_year", cut: bool = False) -> Loaded:
    """Typed claims of fields (field_value_id, source_key, field_name, raw_text, edition year).

    Observations without a stated year take the edition's, with precision ``unknown``. A value that can't be parsed and
    isn't a stated absence is rejected with its code and raw text; so are shares outside 0..100 and coordinates.
    Unmapped fields become narratives when long enough; ignored ones are dropped. Texts are whole unless `cut`.
    """
    held = lambda most: F.substring("raw_text", 1, most) if cut else F.col("raw_text")
    raw = held(MOST_RAW).alias("raw_input")
    d = dispatch(fields, mapping)
    base = ["field_value_id", "source_key", "field_name", "metric", year]
    obs = v.parse_value(d.where("target_kind = 'observation'"), "raw_text", "p")
    failed = F.col("p.failure_code").isNotNull() & F.col("p.missing_reason").isNull()
    period = F.coalesce(F.col("p.reference_year"), F.col(year))
    observations = obs.where(~failed).select(
        *base, "p.value", period.alias("reference_year"), F.when(F.col("p.reference_year").isNull(), "unknown").otherwise("year").alias("period_precision"), "p.status", "p.missing_reason", "p.is_estimate", "p.unit_hint", "p.currency", v.price_basis(F.coalesce("metric", F.lit(""))).alias("price_basis"),
    )
    bad_values = obs.where(failed).select("field_value_id", F.col("p.failure_code").alias("error_code"), raw)
    comp = v.parse_shares(d.where("target_kind = 'composition'"), "raw_text")
    every = comp.select(*base, "raw_text", F.explode("members").alias("m")).select(*base, "raw_text", "m.ordinal", "m.label", "m.share_percent", v.category_code(F.col("m.label")).alias("category"))
    fits = F.coalesce(F.col("share_percent").between(0, 100), F.lit(True))
    members = every.withColumns({"share_percent": F.when(fits, F.col("share_percent")), "is_residual": v.is_residual(F.col("category"))}).drop("raw_text")
    bad_shares = every.where(~fits).select("field_value_id", F.lit("share_out_of_range").alias("error_code"), raw)
    bil = v.parse_partners(d.where("target_kind = 'bilateral'"), "raw_text")
    partners = bil.select(*base, F.explode("partners").alias("m")).select(*base, "m.ordinal", "m.label", "m.value", "m.unit_hint", "m.is_percent").where("lower(label) <> 'total'")
    geo = v.parse_coordinate(d.where("target_kind = 'coordinate'"), "raw_text", "c")
    points = geo.where("c.failure_code is null").select(*base, "c.latitude", "c.longitude")
    bad_points = geo.where("c.failure_code is not null").select("field_value_id", F.col("c.failure_code").alias("error_code"), raw)
    stories = d.where("target_kind is null or target_kind = 'narrative'").where(F.length("raw_text") >= NARRATIVE_LENGTH)
    narratives = stories.select("field_value_id", "source_key", "field_name", held(MOST_TEXT).alias("text"))
    return Loaded(observations, members, partners, points, narratives, bad_values.unionByName(bad_shares).unionByName(bad_points))
