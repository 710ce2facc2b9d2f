"""Entity resolution: codes, then names, valid at a period; refusing rather than choosing between several."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.temporal import overlaps
from ..functions.values import slugify
from .relational import first_by


def resolve(keys: DataFrame, entities: DataFrame) -> DataFrame:
    """keys (source_key, label, from, to) with entity_key, tier and matches.

    entities: (entity_key, code, name, valid_from, valid_to). A code valid in the period decides; else a name, without
    case and outer blanks. One match is ``code`` or ``name``; several are ``ambiguous``, none ``unresolved``, both
    without an entity. Both tiers are equi-joins with the overlap as residual.
    """
    k = keys.withColumn("_k", F.sha2(F.to_json(F.struct("source_key", "label", "from", "to")), 256))
    valid = overlaps(F.col("from"), F.col("to"), F.col("valid_from"), F.col("valid_to"))

    def tier(key, against, name: str) -> DataFrame:
        hit = k.select("_k", "from", "to", key.alias("_on")).join(entities.select("entity_key", "valid_from", "valid_to", against.alias("_on")), "_on").where(valid)
        return hit.groupBy("_k").agg(F.count_distinct("entity_key").alias(f"n_{name}"), F.min("entity_key").alias(f"e_{name}"))

    folded = lambda c: F.nullif(F.lower(F.trim(F.col(c))), F.lit(""))
    out = k.join(tier(folded("source_key"), folded("code"), "code"), "_k", "left").join(tier(folded("label"), folded("name"), "name"), "_k", "left")
    matches = F.coalesce("n_code", "n_name", F.lit(0))
    tier_name = F.when(matches > 1, "ambiguous").when(F.col("n_code") == 1, "code").when(F.col("n_name") == 1, "name").otherwise("unresolved")
    return out.withColumns({"matches": matches, "tier": tier_name, "entity_key": F.when(matches == 1, F.coalesce("e_code", "e_name"))}).drop("_k", "n_code", "e_code", "n_name", "e_name")


def keep_curated(resolved: DataFrame, curated: DataFrame) -> DataFrame:
    """Resolutions, with those a person made (source_key, entity_key) never overwritten."""
    c = curated.select("source_key", F.col("entity_key").alias("_curated"))
    joined = resolved.join(c, "source_key", "left")
    return joined.withColumns({"entity_key": F.coalesce("_curated", "entity_key"), "tier": F.when(F.col("_curated").isNotNull(), "curated").otherwise(F.col("tier"))}).drop("_curated")


def bootstrap(unresolved: DataFrame, existing_slugs: DataFrame) -> DataFrame:
    """source_key, slug, name: one unclassified entity per unresolved key, named by its most used label; slugs already taken get the key behind them."""
    named = first_by(unresolved.groupBy("source_key", "label").agg(F.count("*").alias("uses")), ["source_key"], [F.desc("uses"), F.length("label").desc(), F.asc("label")])
    slugged = named.select("source_key", F.coalesce("label", F.upper("source_key")).alias("name")).withColumn("slug", slugify(F.col("name")))
    taken = existing_slugs.select("slug").distinct().withColumn("_taken", F.lit(True))
    repeated = slugged.groupBy("slug").agg(F.count("*").alias("_n"), F.min("source_key").alias("_first"))
    joined = slugged.join(taken, "slug", "left").join(repeated, "slug")
    clash = F.col("_taken").isNotNull() | ((F.col("_n") > 1) & (F.col("source_key") != F.col("_first")))
    return joined.select("source_key", F.when(clash, F.concat_ws("-", "slug", "source_key")).otherwise(F.col("slug")).alias("slug"), "name")
