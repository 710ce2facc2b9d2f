"""Claims, time, provenance and loading, over the project's tables and the sales tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import temporal, values
from ..operators import claims, load, relational, resolve
from ..session import table as t
from ..streaming import events as stream_events

c = F.col
money = lambda name: F.col(name).cast("decimal(18,2)")


def _order_claims(s: SparkSession, d: str) -> DataFrame:
    """Orders as claims: a customer's value of a priority in a year, published in a month."""
    o = t(s, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("edition"), money("o_totalprice").alias("value"), "o_orderstatus", "o_orderdate")
    return o.join(t(s, d, "customer").select(c("c_custkey").alias("o_custkey"), "c_name"), "o_custkey")


def source_claims(s: SparkSession, d: str) -> DataFrame:
    """Claims of each customer, priority and year, with the sources that make them. #54"""
    out = claims.source_claims(_order_claims(s, d), ["o_custkey", "c_name", "o_orderpriority", "year"], "value", "o_orderstatus", "edition")
    return out.withColumns({x: c(x).cast("double") for x in ("min_value", "max_value")})


def claim_conflicts(s: SparkSession, d: str) -> DataFrame:
    """Groups whose claims disagree. #55"""
    out = claims.conflicts(claims.source_claims(_order_claims(s, d), ["o_custkey", "o_orderpriority", "year"], "value", "o_orderstatus", "edition"))
    return out.select("o_custkey", "o_orderpriority", "year", "claims", "distinct_values", c("min_value").cast("double").alias("min_value"), c("max_value").cast("double").alias("max_value"), F.round("ratio", 6).alias("ratio"))


_CLAIMS_SQL = """SELECT o_custkey, c_name, o_orderpriority, CAST(year(o_orderdate) AS INT) AS year, month(o_orderdate) AS edition, CAST(o_totalprice AS DECIMAL(18,2)) AS value, o_orderstatus FROM orders JOIN customer ON o_custkey = c_custkey"""


def published_claims(s: SparkSession, d: str) -> DataFrame:
    """All claims about a metric of an entity, by data set and edition. #5 of the suite, #54"""
    p = t(s, d, "parsed_value")
    out = claims.source_claims(p, ["source_key", "metric_code", "reference_year"], "raw", "dataset_code", "edition_year")
    return out.select("source_key", "metric_code", "reference_year", "claims", "distinct_values", "datasets", "editions")


def latest_by_period(s: SparkSession, d: str) -> DataFrame:
    """Latest claim of an entity's metric by reference period. #79"""
    p = t(s, d, "parsed_value").select("parsed_value_id", "source_key", "metric_code", "reference_year", "edition_year", "raw")
    return claims.latest(p, ["source_key", "metric_code"], ["reference_year", "edition_year"], "parsed_value_id")


def latest_by_edition(s: SparkSession, d: str) -> DataFrame:
    """Latest claim by edition. #80"""
    p = t(s, d, "parsed_value").select("parsed_value_id", "source_key", "metric_code", "reference_year", "edition_year", "raw")
    return claims.latest(p, ["source_key", "metric_code"], ["edition_year", "reference_year"], "parsed_value_id")


def entity_profile(s: SparkSession, d: str) -> DataFrame:
    """Latest known claims of one entity: the entity's name is among the partition keys, so the filter reaches the scan. #79"""
    return latest_by_period(s, d).where("source_key = 'wx'").select("metric_code", "reference_year", "edition_year", "raw")


def observation_history(s: SparkSession, d: str) -> DataFrame:
    """Yearly revenue of each nation. #25, #91"""
    o, n = t(s, d, "orders"), t(s, d, "nation")
    cu = t(s, d, "customer").select("c_custkey", "c_nationkey")
    joined = o.join(cu, c("o_custkey") == c("c_custkey")).join(n, c("c_nationkey") == c("n_nationkey"))
    return joined.groupBy("n_name", F.year("o_orderdate").alias("year")).agg(F.sum(money("o_totalprice")).cast("double").alias("revenue"))


def yoy_change(s: SparkSession, d: str) -> DataFrame:
    """Change of a region's yearly revenue. #84"""
    o = t(s, d, "orders").join(t(s, d, "customer").select(c("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey")
    r = o.join(t(s, d, "nation"), c("c_nationkey") == c("n_nationkey")).join(t(s, d, "region"), c("n_regionkey") == c("r_regionkey"))
    series = r.groupBy("r_name", F.year("o_orderdate").alias("year")).agg(F.sum(money("o_totalprice")).cast("decimal(18,2)").alias("revenue"))
    out = claims.change(series, ["r_name"], "year", "revenue")
    return out.select("r_name", "year", c("revenue").cast("double").alias("revenue"), c("absolute_change").cast("double").alias("absolute_change"), "percent_change")


def thirty_by_thirty(s: SparkSession, d: str) -> DataFrame:
    """One metric of thirty entities over thirty years. #28, #36"""
    p = t(s, d, "parsed_value").where("metric_code = 'geo.surface' and reference_year between 1990 and 2020")
    e = t(s, d, "entity").orderBy("source_key").limit(30).select("source_key", "label")
    return p.join(e, "source_key").select("parsed_value_id", "source_key", "label", "reference_year", "raw")


def rank_top20(s: SparkSession, d: str) -> DataFrame:
    """The twenty suppliers with most revenue in 1996. #88"""
    li = t(s, d, "lineitem").where(F.year("l_shipdate") == 1996)
    rev = li.groupBy("l_suppkey").agg(F.sum((c("l_extendedprice").cast("decimal(18,2)") * (1 - c("l_discount").cast("decimal(4,2)"))).cast("decimal(18,4)")).alias("revenue"))
    top = rev.join(t(s, d, "supplier"), c("l_suppkey") == c("s_suppkey")).orderBy(F.desc("revenue"), "s_suppkey").limit(20)
    return top.select("s_suppkey", "s_name", c("revenue").cast("double").alias("revenue"))


def provenance_walk(s: SparkSession, d: str) -> DataFrame:
    """From a claim through entity and metric to the file it was published in, with the entity's first staged field. #38, #39"""
    p = t(s, d, "parsed_value").select("parsed_value_id", "dataset_code", "edition_year", "source_key", "metric_code", "raw")
    a = t(s, d, "artifact").where("parser_family <> 'delimited_export' or parser_family is null").select("artifact_id", "dataset_code", "edition_year", "filename")
    e, m = t(s, d, "entity").select("source_key", "label"), t(s, d, "metric").select("metric_code", c("label").alias("metric_label"), "base_unit")
    first = claims.best_per(t(s, d, "raw_field"), "source_key", c("field_value_id"), [c("artifact_id"), c("field_value_id")]).withColumnRenamed("best", "first_field")
    return p.join(a, ["dataset_code", "edition_year"]).join(e, "source_key", "left").join(m, "metric_code", "left").join(first, "source_key", "left")


def dataset_coverage(s: SparkSession, d: str) -> DataFrame:
    """Records, sources, fields and values of each file. #56"""
    f = t(s, d, "raw_field")
    return claims.coverage(t(s, d, "artifact").select("artifact_id", "dataset_code", "edition_year"), f.select("artifact_id", "record_id", "source_key"), f.select("artifact_id", "field_name"))


def field_statistics(s: SparkSession, d: str) -> DataFrame:
    """Values and editions of each field of a data set. #58, #132"""
    f = t(s, d, "raw_field").join(t(s, d, "artifact").select("artifact_id", "dataset_code", "edition_year"), "artifact_id")
    return f.groupBy("dataset_code", "section_name", "field_name").agg(F.count("*").alias("records"), F.count_distinct("edition_year").alias("editions"), F.min("edition_year").alias("first_edition"), F.max("edition_year").alias("last_edition"))


def field_evolution(s: SparkSession, d: str) -> DataFrame:
    """The 400 most used fields and whether they are mapped, ignored or unmapped. #89, #90"""
    f = t(s, d, "raw_field").groupBy("field_name").agg(F.count("*").alias("records"), F.count_distinct("artifact_id").alias("files"))
    m = t(s, d, "metric").select(c("label").alias("field_name"), F.lit(True).alias("_m"))
    label = F.when(c("_m"), "mapped").when(c("field_name").rlike("^[A-Z ]+:?$"), "ignored").otherwise("unmapped")
    return f.join(m, "field_name", "left").select("field_name", "records", "files", label.alias("state")).orderBy(F.desc("records"), "field_name").limit(400)


def modal_label(s: SparkSession, d: str) -> DataFrame:
    """The most used event type of each user. #60, #71, #81"""
    return relational.modal(t(s, d, "events"), ["user_id"], "event_type")


def section_ordinals(s: SparkSession, d: str) -> DataFrame:
    """Sections of a record numbered by their first field: a window over an aggregate. #82, #83"""
    g = t(s, d, "raw_field").groupBy("record_id", "section_name").agg(F.min("field_value_id").alias("first_field"), F.count("*").alias("fields"))
    return g.withColumn("section_ordinal", F.row_number().over(Window.partitionBy("record_id").orderBy("first_field")) - 1)


def entity_resolve(s: SparkSession, d: str) -> DataFrame:
    """Keys of each data set resolved against entities valid in its span. #45, #47, #133"""
    spans = t(s, d, "parsed_value").groupBy("dataset_code", "source_key").agg(F.min("edition_year").alias("a"), F.max("edition_year").alias("b"))
    keys = spans.select("dataset_code", "source_key", F.upper("source_key").alias("label"), F.make_date("a", F.lit(1), F.lit(1)).alias("from"), F.make_date(c("b") + 1, F.lit(1), F.lit(1)).alias("to"))
    e = t(s, d, "entity").select(c("source_key").alias("entity_key"), c("source_key").alias("code"), c("label").alias("name"), "valid_from", "valid_to")
    return resolve.resolve(keys, e).select("dataset_code", "source_key", "tier", "matches", "entity_key")


def resolution_labels(s: SparkSession, d: str) -> DataFrame:
    """Uses of each label of a key, then their extremes: two levels of grouping. #59"""
    g = t(s, d, "documents").groupBy("source_key", "title").agg(F.count("*").alias("uses"), F.min("edition_year").alias("a"), F.max("edition_year").alias("b"))
    return g.groupBy("source_key").agg(F.count("title").alias("labels"), F.sum("uses").alias("uses"), F.min("a").alias("first_edition"), F.max("b").alias("last_edition"))


def unresolved_entities(s: SparkSession, d: str) -> DataFrame:
    """Keys of claims no entity answers to, with the rows that use them. #27, #40, #43"""
    e = t(s, d, "entity").where("valid_to is null").select("source_key")
    return t(s, d, "parsed_value").join(e, "source_key", "left_anti").groupBy("dataset_code", "source_key").agg(F.count("*").alias("rows"))


def temporal_overlaps(s: SparkSession, d: str) -> DataFrame:
    """Orders whose thirty days overlap an earlier order of the customer. #46"""
    o = t(s, d, "orders").select("o_orderkey", "o_custkey", c("o_orderdate").cast("date").alias("valid_from"), F.date_add(c("o_orderdate").cast("date"), 30).alias("valid_to"))
    return temporal.overlap_violations(o, ["o_custkey"], "valid_from", "valid_to", ["o_orderkey"]).select("o_orderkey", "o_custkey")


def period_precision(s: SparkSession, d: str) -> DataFrame:
    """Periods of claims: the stated year, or the edition's with unknown precision. #110"""
    p = t(s, d, "parsed_value")
    period = temporal.year_period(F.when(c("status") == "parsed_exact", c("reference_year")), c("edition_year"))
    return p.select("parsed_value_id", period.alias("p")).select("parsed_value_id", F.date_format("p.start", "yyyy-MM-dd").alias("period_start"), F.date_format("p.end", "yyyy-MM-dd").alias("period_end"), c("p.precision").alias("period_precision"))


def latest_stage(s: SparkSession, d: str) -> DataFrame:
    """The last staged field of each file. #41, #85"""
    g = t(s, d, "raw_field").where("staged_at is not null").groupBy("artifact_id").agg(F.max_by("field_value_id", F.struct("staged_at", "field_value_id")).alias("last_field"))
    return t(s, d, "artifact").select("artifact_id", "filename").join(g, "artifact_id", "left")


def staged_once(s: SparkSession, d: str) -> DataFrame:
    """Fields without those staged twice. #17, #50"""
    return load.staged_once(t(s, d, "raw_field")).groupBy("artifact_id").agg(F.count("*").alias("fields"))


def merge_registry(s: SparkSession, d: str) -> DataFrame:
    """A registry of suppliers with incoming rows merged in. #16, #130"""
    every = t(s, d, "supplier").select("s_suppkey", "s_name", c("s_acctbal").alias("balance"))
    old, new = every.where("s_suppkey % 3 <> 0"), every.where("s_suppkey % 2 = 0").withColumn("s_name", F.concat("s_name", F.lit(" (revised)")))
    return relational.merge_upsert(old, new, ["s_suppkey"])


_MAPPED = [("Surface", "observation", "geo.surface"), ("Shoreline", "observation", "geo.shore"), ("Output", "observation", "econ.output_ppp"), ("Inhabitants", "observation", "demo.people"), ("Ethnic groups", "composition", "demo.groups"), ("Languages", "composition", "demo.languages"), ("Religions", "composition", "demo.religions"), ("Border countries", "bilateral", "geo.borders"), ("Export partners", "bilateral", "econ.partners"), ("Highest point", "coordinate", "geo.peak"), ("Call prefix", "ignore", None)]


def _load(s: SparkSession, d: str) -> load.Loaded:
    f = t(s, d, "raw_field").join(t(s, d, "artifact").select("artifact_id", "edition_year"), "artifact_id")
    mapping = s.createDataFrame([(*m, k) for k, m in enumerate(_MAPPED)], "field_name string, target_kind string, metric string, position int")
    return load.load(f, mapping)


def load_observations(s: SparkSession, d: str) -> DataFrame:
    """Typed observations of mapped fields. #34, #137, #138"""
    return _load(s, d).observations


def load_compositions(s: SparkSession, d: str) -> DataFrame:
    """Members of mapped compositions. #139"""
    return _load(s, d).members


def load_bilaterals(s: SparkSession, d: str) -> DataFrame:
    """Partners of mapped lists. #140"""
    return _load(s, d).partners


def load_rejected(s: SparkSession, d: str) -> DataFrame:
    """Refused values by error code with an example. #69, #143"""
    return _load(s, d).rejected.groupBy("error_code").agg(F.count("*").alias("values"), F.min("raw_input").alias("example"))


def load_narratives(s: SparkSession, d: str) -> DataFrame:
    """Unmapped long texts with their number within the entity. #35, #83, #142"""
    n = _load(s, d).narratives
    return n.withColumn("ordinal", F.row_number().over(Window.partitionBy("source_key", "field_name").orderBy("field_value_id")) - 1).drop("text")


# ---- parsers over built strings, whose typed values SQL knows by arithmetic ---------------------------------------------


def parse_value_scaled(s: SparkSession, d: str) -> DataFrame:
    """"$1.23 million (1995 est.)" of every line. #100"""
    li = t(s, d, "lineitem").select("l_orderkey", "l_linenumber", F.format_string("$%s million (%s est.)", (c("l_quantity").cast("int") / 100).cast("decimal(6,2)").cast("string"), F.year("l_shipdate").cast("string")).alias("raw"))
    p = values.parse_value(li, "raw", "p")
    return p.groupBy("p.status", "p.currency", "p.scale_word", "p.reference_year").agg(F.count("*").alias("rows"), F.sum("p.value").cast("double").alias("total"), F.count_if("p.is_estimate").alias("estimates"))


def parse_value_cases(s: SparkSession, d: str) -> DataFrame:
    """Absences, inequalities, ranges, typing errors and notes, one shape per remainder of the order key. #100, #101, #106"""
    raw = F.element_at(F.array(*map(F.lit, ["NA", "NEGL%", "less than 5%", "15-20% (1991 est.)", "l,600", "data are in 2010 US dollars", "1,234 km", "none (2004)", "12 births/1,000 population", "4% (2017 est.) 4.7% (2016 est.)"])), (c("o_orderkey") % 10 + 1).cast("int"))
    p = values.parse_value(t(s, d, "orders").select("o_orderkey", raw.alias("raw")), "raw", "p")
    return p.groupBy("raw", "p.status", "p.missing_reason", "p.failure_code", c("p.value").cast("double").alias("value"), "p.is_percent", "p.reference_year", "p.inequality", "p.unit_hint").agg(F.count("*").alias("rows"))


def parse_shares_exploded(s: SparkSession, d: str) -> DataFrame:
    """Compositions built of two shares per customer, exploded. #101, #139"""
    cu = t(s, d, "customer").select("c_custkey", F.concat(F.lit("Alpha (official) "), (c("c_custkey") % 60).cast("string"), F.lit("%, Beta, Lower ("), F.lit("x, y) "), (c("c_custkey") % 40).cast("string"), F.lit(".5%, other 1,200 (2001 census)")).alias("raw"))
    m = values.parse_shares(cu, "raw").select("c_custkey", c("header.reference_year").alias("reference_year"), F.explode("members").alias("m"))
    return m.select("c_custkey", "reference_year", "m.ordinal", "m.label", c("m.share_percent").cast("double").alias("share_percent"))


def parse_partners_exploded(s: SparkSession, d: str) -> DataFrame:
    """Partner lists built of suppliers' balances, exploded. #102, #140"""
    su = t(s, d, "supplier").select("s_suppkey", F.concat(c("s_name"), F.lit(" 1,234 km; Land of "), c("s_suppkey").cast("string"), F.lit("x "), (c("s_suppkey") % 97).cast("string"), F.lit(".5%; 12 km; Far isle")).alias("raw"))
    m = values.parse_partners(su, "raw").select("s_suppkey", F.explode("partners").alias("m"))
    return m.select("s_suppkey", "m.ordinal", "m.label", c("m.value").cast("double").alias("value"), "m.unit_hint", "m.is_percent")


def parse_coordinate_points(s: SparkSession, d: str) -> DataFrame:
    """Coordinates written in degrees and minutes from keys, read back. #103, #121"""
    k = t(s, d, "customer").select("c_custkey", (c("c_custkey") % 95).alias("y"), (c("c_custkey") % 59).alias("m"), (c("c_custkey") % 179).alias("x"))
    raw = F.concat(c("y").cast("string"), F.lit(" "), c("m").cast("string"), F.lit(" N, "), c("x").cast("string"), F.lit(" "), c("m").cast("string"), F.when(c("c_custkey") % 2 == 0, " E").otherwise(" W"))
    p = values.parse_coordinate(k.withColumn("raw", raw), "raw", "p")
    return p.select("c_custkey", F.round("p.latitude", 6).alias("latitude"), F.round("p.longitude", 6).alias("longitude"), "p.failure_code")


def bounding_box(s: SparkSession, d: str) -> DataFrame:
    """Points within a box, edges included. #120"""
    return parse_coordinate_points(s, d).where("latitude between 12 and 48 and longitude between -51 and 19").select("c_custkey", "latitude", "longitude")


def bilateral_resolved(s: SparkSession, d: str) -> DataFrame:
    """Partners with the entity their label names, by exact name, then by name in any case; labels nobody answers to are kept. #24b, #47, #140"""
    names = t(s, d, "supplier").select("s_suppkey", "s_name")
    partners = parse_partners_exploded(s, d).select(c("s_suppkey").alias("subject"), "ordinal", F.when(c("ordinal") == 0, F.upper("label")).otherwise(c("label")).alias("label"), "value")
    out = relational.tiered(partners.withColumn("key", c("label")), [("exact", names.select(c("s_name").alias("key"), c("s_suppkey").alias("object")))], "key", "object")
    rest = out.where("tier is null").select("subject", "ordinal", "label", "value", F.lower(F.trim("label")).alias("key"))
    folded = relational.tiered(rest, [("name", names.select(F.lower(F.trim("s_name")).alias("key"), c("s_suppkey").alias("object")))], "key", "object")
    return out.where("tier is not null").select("subject", "ordinal", "label", "value", "tier", "object").unionByName(folded.select("subject", "ordinal", "label", "value", "tier", "object"))


def composition_view(s: SparkSession, d: str) -> DataFrame:
    """Members of compositions with the category they belong to and whether it is the rest. #24a, #112"""
    m = parse_shares_exploded(s, d).withColumn("category", values.category_code(c("label")))
    return m.select("c_custkey", "ordinal", "category", values.is_residual(c("category")).alias("is_residual"), "share_percent")


def events_tumbling(s: SparkSession, d: str) -> DataFrame:
    """Events and value per hour and type: the batch form of the stream. Extension, §2.11"""
    e = t(s, d, "events").withColumn("ts", c("ts").cast("timestamp"))
    return stream_events.tumbling(e).select(F.date_format("window_start", "yyyy-MM-dd HH").alias("hour"), "event_type", "events", c("total").cast("double").alias("total"))


def events_sessions(s: SparkSession, d: str) -> DataFrame:
    """Sessions of each user, parted by half an hour of silence. Extension, §2.11"""
    e = t(s, d, "events").withColumn("ts", c("ts").cast("timestamp"))
    return stream_events.sessions(e).groupBy("user_id").agg(F.count("*").alias("sessions"), F.sum("events").alias("events"))


_COORD = """SELECT c_custkey, c_custkey % 95 + (c_custkey % 59) / 60.0::DOUBLE AS y, (c_custkey % 179 + (c_custkey % 59) / 60.0::DOUBLE) * CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE -1 END AS x FROM customer"""
_CASES = """(VALUES (0,'NA','unparsed','not_reported',NULL,NULL,false,NULL,NULL,NULL),(1,'NEGL%','unparsed','negligible',NULL,NULL,false,NULL,NULL,NULL),(2,'less than 5%','parsed_partial',NULL,NULL,5.0,true,NULL,'less_than',NULL),
(3,'15-20% (1991 est.)','parsed_partial',NULL,NULL,15.0,true,1991,NULL,NULL),(4,'l,600','unparsed',NULL,'no_number_found',NULL,false,NULL,NULL,NULL),(5,'data are in 2010 US dollars','unparsed',NULL,'explanatory_note_not_a_value',NULL,false,2010,NULL,NULL),
(6,'1,234 km','parsed_exact',NULL,NULL,1234.0,false,NULL,NULL,'km'),(7,'none (2004)','unparsed','not_applicable',NULL,NULL,false,2004,NULL,NULL),(8,'12 births/1,000 population','parsed_exact',NULL,NULL,12.0,false,NULL,NULL,NULL),(9,'4% (2017 est.) 4.7% (2016 est.)','parsed_partial',NULL,NULL,4.0,true,2017,NULL,NULL))
 AS x(k, raw, status, missing_reason, failure_code, value, is_percent, reference_year, inequality, unit_hint)"""
_FIELDS = "(SELECT *, row_number() OVER (PARTITION BY record_id, section_name, field_name, subfield_name, ordinal, raw_text ORDER BY staged_at NULLS LAST, field_value_id) AS rn FROM raw_field)"

NAMES = (
    source_claims, claim_conflicts, published_claims, latest_by_period, latest_by_edition, entity_profile, observation_history, yoy_change, thirty_by_thirty, rank_top20, provenance_walk, dataset_coverage, field_statistics, field_evolution, modal_label, section_ordinals,
    entity_resolve, resolution_labels, unresolved_entities, temporal_overlaps, period_precision, latest_stage, staged_once, merge_registry, load_observations, load_compositions, load_bilaterals, load_rejected, load_narratives, parse_value_scaled, parse_value_cases,
    parse_shares_exploded, parse_partners_exploded, parse_coordinate_points, bounding_box, bilateral_resolved, composition_view, events_tumbling, events_sessions,
)
QUERIES = {f.__name__: f for f in NAMES}
SQL = {
    "source_claims": f"SELECT o_custkey, c_name, o_orderpriority, year, count(*) AS claims, count(DISTINCT value) AS distinct_values, CAST(min(value) AS DOUBLE) AS min_value, CAST(max(value) AS DOUBLE) AS max_value, array_to_string(list_sort(list(DISTINCT o_orderstatus)), ',') AS datasets, array_to_string(list_sort(list(DISTINCT edition)), ',') AS editions FROM ({_CLAIMS_SQL}) GROUP BY ALL",
    "claim_conflicts": f"SELECT o_custkey, o_orderpriority, year, count(*) AS claims, count(DISTINCT value) AS distinct_values, CAST(min(value) AS DOUBLE) AS min_value, CAST(max(value) AS DOUBLE) AS max_value, round(CAST(max(value) AS DOUBLE) / CAST(min(value) AS DOUBLE), 6) AS ratio FROM ({_CLAIMS_SQL}) GROUP BY o_custkey, o_orderpriority, year HAVING count(DISTINCT value) > 1",
    "published_claims": "SELECT source_key, metric_code, reference_year, count(*) AS claims, count(DISTINCT raw) AS distinct_values, array_to_string(list_sort(list(DISTINCT dataset_code)), ',') AS datasets, array_to_string(list_sort(list(DISTINCT edition_year)), ',') AS editions FROM parsed_value GROUP BY ALL",
    "latest_by_period": "SELECT parsed_value_id, source_key, metric_code, reference_year, edition_year, raw FROM parsed_value QUALIFY row_number() OVER (PARTITION BY source_key, metric_code ORDER BY reference_year DESC NULLS LAST, edition_year DESC NULLS LAST, parsed_value_id DESC) = 1",
    "latest_by_edition": "SELECT parsed_value_id, source_key, metric_code, reference_year, edition_year, raw FROM parsed_value QUALIFY row_number() OVER (PARTITION BY source_key, metric_code ORDER BY edition_year DESC NULLS LAST, reference_year DESC NULLS LAST, parsed_value_id DESC) = 1",
    "entity_profile": "SELECT metric_code, reference_year, edition_year, raw FROM parsed_value WHERE source_key = 'wx' QUALIFY row_number() OVER (PARTITION BY metric_code ORDER BY reference_year DESC NULLS LAST, edition_year DESC NULLS LAST, parsed_value_id DESC) = 1",
    "observation_history": "SELECT n_name, CAST(year(o_orderdate) AS INT) AS year, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL",
    "yoy_change": "WITH y AS (SELECT r_name, CAST(year(o_orderdate) AS INT) AS year, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS v FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL), l AS (SELECT *, lag(v) OVER (PARTITION BY r_name ORDER BY year) AS b FROM y) SELECT r_name, year, CAST(v AS DOUBLE) AS revenue, CAST(v - b AS DOUBLE) AS absolute_change, round(100 * (CAST(v - b AS DOUBLE) / nullif(CAST(b AS DOUBLE), 0)), 2) AS percent_change FROM l",
    "thirty_by_thirty": "SELECT parsed_value_id, source_key, label, reference_year, raw FROM parsed_value JOIN (SELECT source_key, label FROM entity ORDER BY source_key LIMIT 30) USING (source_key) WHERE metric_code = 'geo.surface' AND reference_year BETWEEN 1990 AND 2020",
    "rank_top20": "SELECT s_suppkey, s_name, CAST(sum(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4))) AS DOUBLE) AS revenue FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE year(l_shipdate) = 1996 GROUP BY ALL ORDER BY 3 DESC, 1 LIMIT 20",
    "provenance_walk": "SELECT p.parsed_value_id, p.dataset_code, p.edition_year, p.source_key, p.metric_code, p.raw, a.artifact_id, a.filename, e.label, m.label AS metric_label, m.base_unit, f.first_field FROM parsed_value p JOIN artifact a ON p.dataset_code = a.dataset_code AND p.edition_year = a.edition_year AND a.parser_family IS DISTINCT FROM 'delimited_export' LEFT JOIN entity e ON p.source_key = e.source_key LEFT JOIN metric m ON p.metric_code = m.metric_code LEFT JOIN (SELECT source_key, arg_min(field_value_id, (artifact_id, field_value_id)) AS first_field FROM raw_field GROUP BY 1) f ON f.source_key = p.source_key",
    "dataset_coverage": "SELECT a.artifact_id, a.dataset_code, a.edition_year, count(DISTINCT r.record_id) AS records, count(DISTINCT r.source_key) AS sources, count(DISTINCT r.field_name) AS fields, count(r.field_value_id) AS values FROM artifact a LEFT JOIN raw_field r USING (artifact_id) GROUP BY ALL",
    "field_statistics": "SELECT dataset_code, section_name, field_name, count(*) AS records, count(DISTINCT edition_year) AS editions, min(edition_year) AS first_edition, max(edition_year) AS last_edition FROM raw_field JOIN artifact USING (artifact_id) GROUP BY ALL",
    "field_evolution": "SELECT field_name, count(*) AS records, count(DISTINCT artifact_id) AS files, CASE WHEN field_name IN (SELECT label FROM metric) THEN 'mapped' WHEN regexp_full_match(field_name, '[A-Z ]+:?') THEN 'ignored' ELSE 'unmapped' END AS state FROM raw_field GROUP BY field_name ORDER BY 2 DESC, 1 LIMIT 400",
    "modal_label": "WITH g AS (SELECT user_id, event_type, count(*) AS uses FROM events WHERE event_type IS NOT NULL GROUP BY user_id, event_type) SELECT user_id, event_type, uses FROM g QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY uses DESC, length(event_type) DESC, event_type) = 1",
    "section_ordinals": "SELECT record_id, section_name, min(field_value_id) AS first_field, count(*) AS fields, CAST(row_number() OVER (PARTITION BY record_id ORDER BY min(field_value_id)) - 1 AS INT) AS section_ordinal FROM raw_field GROUP BY record_id, section_name",
    "entity_resolve": """WITH k AS (SELECT dataset_code, source_key, make_date(min(edition_year), 1, 1) AS a, make_date(max(edition_year) + 1, 1, 1) AS b FROM parsed_value GROUP BY ALL),
n AS (SELECT k.dataset_code, k.source_key, count(DISTINCT e.source_key) FILTER (WHERE lower(trim(e.source_key)) = lower(trim(k.source_key))) AS codes, min(e.source_key) FILTER (WHERE lower(trim(e.source_key)) = lower(trim(k.source_key))) AS code, count(DISTINCT e.source_key) FILTER (WHERE lower(trim(e.label)) = lower(trim(k.source_key))) AS names, min(e.source_key) FILTER (WHERE lower(trim(e.label)) = lower(trim(k.source_key))) AS name
FROM k LEFT JOIN entity e ON coalesce(e.valid_from, DATE '0001-01-01') < k.b AND k.a < coalesce(e.valid_to, DATE '9999-12-31') AND (lower(trim(e.source_key)) = lower(trim(k.source_key)) OR lower(trim(e.label)) = lower(trim(k.source_key))) GROUP BY ALL)
SELECT dataset_code, source_key, CASE WHEN codes > 1 OR codes = 0 AND names > 1 THEN 'ambiguous' WHEN codes = 1 THEN 'code' WHEN names = 1 THEN 'name' ELSE 'unresolved' END AS tier, CASE WHEN codes > 0 THEN codes ELSE names END AS matches, CASE WHEN codes = 1 THEN code WHEN codes = 0 AND names = 1 THEN name END AS entity_key FROM n""",
    "resolution_labels": "SELECT source_key, count(DISTINCT title) AS labels, count(*) AS uses, min(edition_year) AS first_edition, max(edition_year) AS last_edition FROM documents GROUP BY source_key",
    "unresolved_entities": "SELECT dataset_code, source_key, count(*) AS rows FROM parsed_value p WHERE NOT EXISTS (SELECT 1 FROM entity e WHERE e.source_key = p.source_key AND e.valid_to IS NULL) GROUP BY ALL",
    "temporal_overlaps": "WITH o AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS a, CAST(o_orderdate AS DATE) + 30 AS b FROM orders) SELECT o_orderkey, o_custkey FROM (SELECT *, max(b) OVER (PARTITION BY o_custkey ORDER BY a, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM o) WHERE a < reach",
    "period_precision": "SELECT parsed_value_id, strftime(make_date(coalesce(CASE WHEN status = 'parsed_exact' THEN reference_year END, edition_year), 1, 1), '%Y-%m-%d') AS period_start, strftime(make_date(coalesce(CASE WHEN status = 'parsed_exact' THEN reference_year END, edition_year) + 1, 1, 1), '%Y-%m-%d') AS period_end, CASE WHEN status = 'parsed_exact' AND reference_year IS NOT NULL THEN 'year' ELSE 'unknown' END AS period_precision FROM parsed_value",
    "latest_stage": "SELECT artifact_id, filename, (SELECT field_value_id FROM raw_field r WHERE r.artifact_id = a.artifact_id AND staged_at IS NOT NULL ORDER BY staged_at DESC, field_value_id DESC LIMIT 1) AS last_field FROM artifact a",
    "staged_once": f"SELECT artifact_id, count(*) AS fields FROM {_FIELDS} WHERE rn = 1 GROUP BY artifact_id",
    "merge_registry": "SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN s_name || ' (revised)' ELSE s_name END AS s_name, s_acctbal AS balance FROM supplier WHERE s_suppkey % 3 <> 0 OR s_suppkey % 2 = 0",
    "load_narratives": f"""SELECT field_value_id, source_key, field_name, CAST(row_number() OVER (PARTITION BY source_key, field_name ORDER BY field_value_id) - 1 AS INT) AS ordinal FROM raw_field WHERE field_name NOT IN ({', '.join(f"'{m[0]}'" for m in _MAPPED)}) AND length(raw_text) >= 200""",
    "parse_value_scaled": "SELECT 'parsed_with_qualifier' AS status, 'USD' AS currency, 'million' AS scale_word, CAST(year(l_shipdate) AS INT) AS reference_year, count(*) AS rows, CAST(sum(CAST(l_quantity AS INT)) * 10000 AS DOUBLE) AS total, count(*) AS estimates FROM lineitem GROUP BY ALL",
    "parse_value_cases": f"SELECT raw, status, missing_reason, failure_code, CAST(value AS DOUBLE) AS value, is_percent, CAST(reference_year AS INT) AS reference_year, inequality, unit_hint, count(*) AS rows FROM orders JOIN {_CASES} ON o_orderkey % 10 = k GROUP BY ALL",
    "parse_shares_exploded": "SELECT c_custkey, 2001::INT AS reference_year, ordinal::INT AS ordinal, label, share_percent FROM customer, LATERAL (VALUES (0, 'Alpha', (c_custkey % 60)::DOUBLE), (1, 'Beta', NULL), (2, 'Lower', (c_custkey % 40) + 0.5::DOUBLE), (3, 'other 1,200', NULL)) AS x(ordinal, label, share_percent)",
    "parse_partners_exploded": "SELECT s_suppkey, ordinal::INT AS ordinal, label, value, unit_hint, is_percent FROM supplier, LATERAL (VALUES (0, s_name, 1234::DOUBLE, 'km', false), (1, 'Land of ' || s_suppkey || 'x', (s_suppkey % 97) + 0.5::DOUBLE, NULL, true), (3, 'Far isle', NULL, NULL, false)) AS x(ordinal, label, value, unit_hint, is_percent)",
    "bilateral_resolved": "SELECT s_suppkey AS subject, ordinal::INT AS ordinal, label, value, tier, object FROM supplier, LATERAL (VALUES (0, upper(s_name), 1234::DOUBLE, 'name', s_suppkey), (1, 'Land of ' || s_suppkey || 'x', (s_suppkey % 97) + 0.5::DOUBLE, NULL, NULL), (3, 'Far isle', NULL, NULL, NULL)) AS x(ordinal, label, value, tier, object)",
    "composition_view": "SELECT c_custkey, ordinal::INT AS ordinal, category, false AS is_residual, share_percent FROM customer, LATERAL (VALUES (0, 'alpha', (c_custkey % 60)::DOUBLE), (1, 'beta', NULL), (2, 'lower', (c_custkey % 40) + 0.5::DOUBLE), (3, 'other 1,200', NULL)) AS x(ordinal, category, share_percent)",
    "events_tumbling": "SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H') AS hour, event_type, count(*) AS events, CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) AS total FROM events GROUP BY ALL",
    "events_sessions": "SELECT user_id, CAST(sum(n) AS BIGINT) AS sessions, count(*) AS events FROM (SELECT user_id, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS n FROM events) GROUP BY user_id",
    "parse_coordinate_points": f"SELECT c_custkey, CASE WHEN y <= 90 THEN round(y, 6) END AS latitude, CASE WHEN y <= 90 THEN round(x, 6) END AS longitude, CASE WHEN y > 90 THEN 'out_of_range' END AS failure_code FROM ({_COORD})",
    "bounding_box": f"SELECT c_custkey, round(y, 6) AS latitude, round(x, 6) AS longitude FROM ({_COORD}) WHERE round(y, 6) BETWEEN 12 AND 48 AND round(x, 6) BETWEEN -51 AND 19",
}
