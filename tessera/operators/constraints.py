"""Integrity rules of claims as queries: every violation is a row that names its rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.temporal import overlap_violations
from .quality import not_unique, orphans, violations

TYPED = ("value_int", "value_num", "value_bool", "value_cat", "value_text")
#: The typed column of each kind of value (fixed values).
KIND_COLUMN = {"integer": "value_int", "numeric": "value_num", "boolean": "value_bool", "categorical": "value_cat", "text": "value_text"}


def typed_values() -> Column:
    """How many typed columns of a claim are filled."""
    return sum((F.col(c).isNotNull().cast("int") for c in TYPED[1:]), F.col(TYPED[0]).isNotNull().cast("int"))


def claim_rules() -> dict[str, Column]:
    """Rules of one claim row; a null outcome counts as kept."""
    c = F.col
    filled = F.coalesce(F.create_map(*[F.lit(x) for k, v in KIND_COLUMN.items() for x in (k, v)])[c("value_kind")], F.lit(""))
    right = F.greatest(*(F.when(c(v).isNotNull() & (filled == v), 1).otherwise(0) for v in TYPED)) == 1
    return {
        "period_precision_set": c("period_start").isNull() | c("period_precision").isNotNull(),
        "period_not_empty": c("period_end") > c("period_start"),
        "price_basis_set": c("price_basis").isNotNull(),
        "currency_needs_basis": c("currency").isNull() | (c("price_basis") != "none"),
        "missing_iff_unparsed": (c("parse_status") == "unparsed") == c("missing_reason").isNotNull(),
        "has_provenance": c("field_value_id").isNotNull(),
        "exactly_one_value": typed_values() == F.when(c("parse_status") == "unparsed", 0).otherwise(1),
        "value_of_its_kind": (typed_values() == 0) | right,
    }


def check_claims(claims: DataFrame, metrics: DataFrame) -> DataFrame:
    """rule, key of every violation: row rules, kind decided by the metric, and references to metrics."""
    row = violations(claims, claim_rules(), F.col("claim_id"))
    kinds = claims.join(metrics.select("metric_id", F.col("value_kind").alias("_kind")), "metric_id").where("_kind <> value_kind").select(F.lit("kind_of_metric").alias("rule"), F.col("claim_id").cast("string").alias("key"))
    lost = orphans(claims, metrics, ["metric_id"]).select(F.lit("metric_exists").alias("rule"), F.col("claim_id").cast("string").alias("key"))
    return row.unionByName(kinds).unionByName(lost)


def check_registry(names: DataFrame, identifiers: DataFrame) -> DataFrame:
    """rule, key: one preferred name of an entity at a time; one code names one entity at a time, unless marked erroneous; no identifier overlaps itself."""
    preferred = overlap_violations(names.where("is_preferred"), ["entity_id"], "valid_from", "valid_to", ["name"]).select(F.lit("one_preferred_name").alias("rule"), F.col("entity_id").cast("string").alias("key"))
    live = identifiers.where("status is null or status <> 'erroneous'")
    codes = overlap_violations(live, ["scheme", "code"], "valid_from", "valid_to", ["entity_id"]).select(F.lit("one_entity_per_code").alias("rule"), F.concat_ws(":", "scheme", "code").alias("key"))
    itself = overlap_violations(identifiers, ["entity_id", "scheme", "code"], "valid_from", "valid_to", ["entity_id"]).select(F.lit("no_self_overlap").alias("rule"), F.concat_ws(":", F.col("entity_id").cast("string"), "scheme", "code").alias("key"))
    return preferred.unionByName(codes).unionByName(itself)


def check_bilaterals(edges: DataFrame) -> DataFrame:
    """rule, key: an edge doesn't lead back to its subject, and names its object by entity or label."""
    rules = {"not_reflexive": F.col("subject_id") != F.col("object_id"), "object_identified": F.col("object_id").isNotNull() | (F.trim("object_label") != "")}
    return violations(edges, {k: F.coalesce(v, F.lit(k == "not_reflexive")) for k, v in rules.items()}, F.col("edge_id"))


def check_compositions(members: DataFrame) -> DataFrame:
    """rule, key: a member has a share or an amount, the share lies in 0..100, and an ordinal stands once in its list."""
    rules = {"quantity_present": F.col("share_percent").isNotNull() | F.col("amount").isNotNull(), "share_in_range": F.col("share_percent").between(0, 100)}
    repeated = not_unique(members, ["composition_id", "ordinal"]).select(F.lit("ordinal_unique").alias("rule"), F.col("composition_id").cast("string").alias("key"))
    return violations(members, rules, F.col("composition_id")).unionByName(repeated)
