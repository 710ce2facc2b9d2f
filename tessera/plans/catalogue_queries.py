"""Catalogue, search, quality and mart, over the project's tables and the sales tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions import urls, values
from ..functions.temporal import holds
from ..operators import facets, mart, quality, relational, search
from ..session import table as t
from ..sources import catalogue, manifest

c = F.col

#: Sensitive and infrastructure words of the classification (fixed values of this query).
CLASSES = (("infrastructure", r"(?i)^https?://(?:localhost|127\.|10\.|192\.168\.)"), ("sensitive", r"(?i)health|court"), ("regional", r"(?i)kind\s*[=:]\s*regional"))
TOPICS = ("addresses", "agriculture", "courts", "geology", "health", "water")
AS_OF = "2025-06-30"


def _items(s: SparkSession, d: str) -> DataFrame:
    return t(s, d, "catalogue_item")


def _urls(s: SparkSession, d: str) -> DataFrame:
    return _items(s, d).where("url is not null").select("item_id", "country", "url", urls.host(c("url")).alias("domain"))


def facet_counts(s: SparkSession, d: str) -> DataFrame:
    """Languages, sources and sections, each counted under the filters of the others. #75"""
    return facets.facet_counts(t(s, d, "documents"), ["lang", "source", "section_name"], {"lang": ["en", "fr"], "source": ["archive_text", "gazetteer"]})


def coverage_grid(s: SparkSession, d: str) -> DataFrame:
    """Countries × listed topics, with the rest and a total. #72"""
    g = facets.coverage_grid(_items(s, d), "country", "topic", TOPICS)
    return g.select("country", *(c(f"`{x}`").alias(f"topic_{x}") for x in [*TOPICS, "other"]), "total")


def topic_rollup(s: SparkSession, d: str) -> DataFrame:
    """Items, countries and shares of official and machine-readable items by topic. #73, #169"""
    kind = F.lower("attrs")
    return facets.rollup(_items(s, d), "topic", "country", {"official_share": kind.rlike(r"kind\s*[=:]\s*official"), "machine_share": kind.rlike(r"data\s*[=:]\s*(api|bulk|ogc)")})


def value_counts(s: SparkSession, d: str) -> DataFrame:
    """Countries by number of items, ties by first occurrence. #74"""
    return facets.value_counts(_items(s, d), "country", "item_id")


def supra_counts(s: SparkSession, d: str) -> DataFrame:
    """Items by topic of the union and of the rest, counted in one pass. #63, #76"""
    return _items(s, d).groupBy("topic").agg(F.count_if(c("country") == "EU").alias("union_items"), F.count_if(c("country") != "EU").alias("national_items"))


def catalogue_filter(s: SparkSession, d: str) -> DataFrame:
    """Items of a country and topic whose name, host or description holds a word. #31"""
    i = _items(s, d)
    hay = F.lower(F.concat_ws(" ", "name", urls.host(c("url")), "descr"))
    return i.where((c("country") == "EU") & c("topic").isin("courts", "water") & hay.contains("harbour")).select("item_id", "topic", "name")


def holes(s: SparkSession, d: str) -> DataFrame:
    """Country and topic cells that are neither filled nor a documented gap. #97, #164, #169"""
    i = _items(s, d)
    gaps = i.where("topic = 'water'").select("country").distinct().select("country", F.lit("geology").alias("topic"))
    return facets.holes(i, i, i, gaps, "country", "topic")


def related_topics(s: SparkSession, d: str) -> DataFrame:
    """Topics that share a host with a topic, with the items under a country filter; edges without their reverse are none. #49, #163, #170"""
    u = _items(s, d).where("url is not null").select("topic", urls.host(c("url")).alias("domain")).distinct()
    edges = u.alias("a").join(u.alias("b"), "domain").where("a.topic < b.topic").select(c("a.topic").alias("topic"), c("b.topic").alias("related")).distinct()
    n = _items(s, d).where("country = 'EU'").groupBy(c("topic").alias("related")).agg(F.count("*").alias("items"))
    return edges.join(n, "related").select("topic", "related", "items")


def catalogue_order(s: SparkSession, d: str) -> DataFrame:
    """Rank of each item by topic, country, file and place within its file. #93"""
    w = Window.partitionBy("topic").orderBy("country", "source_file", "item_id")
    return _items(s, d).select("item_id", "topic", F.row_number().over(w).alias("place"))


def page_two(s: SparkSession, d: str) -> DataFrame:
    """The second page of fifty items. #94"""
    return relational.page(_items(s, d).select("item_id", "name"), [c("item_id")], 2)


def url_keys(s: SparkSession, d: str) -> DataFrame:
    """Host, same-place, canonical and normal key of each URL. #123–#126"""
    return _urls(s, d).select("item_id", "domain", urls.same_place(c("url")).alias("same_place"), urls.canonical(c("url")).alias("canonical"), urls.norm(c("url")).alias("norm"), urls.is_root(c("url")).alias("is_root"))


def url_scrubbed(s: SparkSession, d: str) -> DataFrame:
    """URLs without query and fragment. #33"""
    return _urls(s, d).select("item_id", urls.scrub(c("url")).alias("url"))


def url_evidence(s: SparkSession, d: str) -> DataFrame:
    """Items at or under the shortest path of another item of their domain. #52"""
    u = _urls(s, d).select("item_id", "domain", urls.norm(c("url")).alias("norm"), F.lower(urls.path(c("url"))).alias("path"))
    first = F.regexp_extract("path", r"^(/[^/]+)", 1)
    roots = u.groupBy("domain").agg(F.min_by(first, c("item_id")).alias("root_path"))
    return relational.prefix_join(u, roots, "domain", "path", "root_path").select("item_id", c("d.domain").alias("domain"), "root_path")


def domain_stats(s: SparkSession, d: str) -> DataFrame:
    """Items, URLs, last verification and first URL of each domain. #70, #166"""
    return _urls(s, d).join(_items(s, d).select("item_id", "verified_on"), "item_id").groupBy("domain").agg(F.count("*").alias("items"), F.count_distinct("url").alias("urls"), F.date_format(F.max("verified_on"), "yyyy-MM-dd").alias("last_verified"), F.substring(F.min("url"), 1, 150).alias("first_url"))


def deep_domains(s: SparkSession, d: str) -> DataFrame:
    """Domains of a country with at least four deep pages. #78"""
    u = _urls(s, d).withColumn("root", urls.is_root(c("url")))
    return u.groupBy("country", "domain").agg(F.bool_or("root").alias("has_root"), F.count_if(~c("root")).alias("deep")).where("deep >= 4")


def sanitise_classes(s: SparkSession, d: str) -> DataFrame:
    """The first class an item meets, by an ordered list. #32, #165"""
    hay = F.concat_ws(" ", "url", "topic", "attrs")
    return _items(s, d).select("item_id", facets.classify(hay, CLASSES, "keep").alias("class"))


def source_label(s: SparkSession, d: str) -> DataFrame:
    """Which of two kinds of evidence a country has. #167, #171"""
    g = _items(s, d).groupBy("country").agg(F.count("url").alias("with_url"), F.count("verified_on").alias("verified"))
    return g.select("country", F.concat_ws("+", F.when(c("with_url") > 0, "url"), F.when(c("verified") > 0, "verified")).alias("evidence"))


def freshness(s: SparkSession, d: str) -> DataFrame:
    """Verification dates judged as of a fixed day. #128"""
    age = F.datediff(F.lit(AS_OF).cast("date"), c("verified_on"))
    state = F.when(age.isNull(), "missing").when(age < -1, "error").when(age > 730, "warning").otherwise("ok")
    return _items(s, d).select("item_id", age.alias("age_days"), state.alias("state"))


def link_states(s: SparkSession, d: str) -> DataFrame:
    """Buckets of probes, the codes made from the id. #77, #127"""
    code = lambda k: F.element_at(F.array(*(F.lit(x).cast("int") for x in (200, 301, 403, 404, 500, None, 410, 200))), ((c("item_id") * k) % 8 + 1).cast("int"))
    return _items(s, d).select(urls.link_state(code(1), code(3), code(5)).alias("state")).groupBy("state").agg(F.count("*").alias("links"))


def catalogue_faults(s: SparkSession, d: str) -> DataFrame:
    """Rules each item breaks: short descriptions, missing URLs, later dates, repeated URLs. #161, #162"""
    i = _items(s, d).withColumn("n_url", F.count("*").over(Window.partitionBy("url")))
    rules = {"no_url": c("url").isNotNull(), "short_description": F.length("descr") >= 60, "no_description": c("descr").isNotNull(), "not_https": c("url").startswith("https://"), "late": c("verified_on") <= F.lit(AS_OF).cast("date")}
    single = quality.violations(i, rules, c("item_id"))
    return single.groupBy("rule").agg(F.count("*").alias("items"))


def repeated_urls(s: SparkSession, d: str) -> DataFrame:
    """URLs of more than one item. #161"""
    return quality.not_unique(_items(s, d).where("url is not null"), ["url"]).withColumnRenamed("rows", "items")


def fuzzy_names(s: SparkSession, d: str) -> DataFrame:
    """The ten labels nearest a misspelt name by trigrams. #119"""
    return search.fuzzy(t(s, d, "entity").where("label is not null"), "source_key", "label", "Stouxsiasvick")


def fuzzy_pairs(s: SparkSession, d: str) -> DataFrame:
    """Entities whose labels resemble that of another. #119"""
    e = t(s, d, "entity").where("label is not null").select("source_key", "label")
    return search.fuzzy_join(e, "source_key", "label", e, "source_key", "label", 0.3).where("source_key_left < source_key_right")


def text_search(s: SparkSession, d: str) -> DataFrame:
    """Documents with all words of a query, ranked. #116–#118"""
    index = search.inverted_index(t(s, d, "documents"), "doc_id", c("text"))
    return search.all_terms(index, "doc_id", search.query_terms(s, "harbours of the ferry"))


def text_top10(s: SparkSession, d: str) -> DataFrame:
    """The ten best documents of a search, ties by id. #92, #117"""
    index = search.inverted_index(t(s, d, "documents"), "doc_id", c("text"))
    return search.all_terms(index, "doc_id", search.query_terms(s, "water")).orderBy(F.desc("rank"), "doc_id").limit(10)


def set_operations(s: SparkSession, d: str) -> DataFrame:
    """Customers of one year only, of both, and either. #96–#99"""
    o = t(s, d, "orders")
    a, b = (o.where(F.year("o_orderdate") == y).select("o_custkey").distinct() for y in (1996, 1997))
    label = lambda df, name: df.select("o_custkey", F.lit(name).alias("part"))
    return label(a.exceptAll(b), "difference").unionByName(label(a.intersect(b), "intersection")).unionByName(label(a.union(b).distinct(), "union"))


def customers_without(s: SparkSession, d: str) -> DataFrame:
    """Customers without an order in 1996. #43"""
    o = t(s, d, "orders").where(F.year("o_orderdate") == 1996).select(c("o_custkey").alias("c_custkey"))
    return t(s, d, "customer").join(o, "c_custkey", "left_anti").select("c_custkey", "c_name")


def orders_returned(s: SparkSession, d: str) -> DataFrame:
    """Orders with a returned line. #42"""
    li = t(s, d, "lineitem").where("l_returnflag = 'R'").select(c("l_orderkey").alias("o_orderkey"))
    return t(s, d, "orders").join(li, "o_orderkey", "left_semi").select("o_orderkey", "o_custkey")


def file_differences(s: SparkSession, d: str) -> DataFrame:
    """Data sets of claims and of files set side by side. #53"""
    p, a = (t(s, d, n).select("dataset_code").distinct() for n in ("parsed_value", "artifact"))
    full = p.withColumn("_p", F.lit(True)).join(a.withColumn("_a", F.lit(True)), "dataset_code", "full")
    return full.select("dataset_code", F.when(c("_p").isNull(), "files only").when(c("_a").isNull(), "claims only").otherwise("both").alias("side"))


def ordered_fingerprint(s: SparkSession, d: str) -> DataFrame:
    """MD5 of the units of each quantity kind in order: a fingerprint of a fixed rule table. #67"""
    g = t(s, d, "unit_reference").groupBy("quantity_kind").agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "unit_code", "unit_label"))), ",").alias("x"))
    return g.select("quantity_kind", F.md5("x").alias("fingerprint"))


def json_props(s: SparkSession, d: str) -> DataFrame:
    """A number out of each event's JSON, by type. #12"""
    k = F.get_json_object("props", "$.k").cast("bigint")
    return t(s, d, "events").groupBy("event_type").agg(F.sum(k).alias("k"), F.count(k).alias("events"))


def totals_row(s: SparkSession, d: str) -> DataFrame:
    """Rows of each table. #64"""
    names = ("entity", "metric", "artifact", "raw_field", "parsed_value", "raw_line", "catalogue_item", "documents")
    parts = [t(s, d, n).agg(F.count("*").alias("rows")).select(F.lit(n).alias("name"), "rows") for n in names]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def dim_period(s: SparkSession, d: str) -> DataFrame:
    """Months of the orders. #145"""
    p = mart.dim_period(c("o_orderdate").cast("date"), c("o_orderdate").cast("date"), t(s, d, "orders"))
    return p.select("period_key", "year", "quarter", "month", "label")


def dim_entity(s: SparkSession, d: str) -> DataFrame:
    """Entities with a name whatever they lack. #22, #39, #145"""
    return mart.dim_entity(t(s, d, "entity")).drop("entity_key")


def fact_observation(s: SparkSession, d: str) -> DataFrame:
    """Claims of areas and lengths with their metric. #30, #145"""
    f = mart.fact_observation(t(s, d, "parsed_value"), t(s, d, "metric"), ("area", "length"))
    return f.select("parsed_value_id", "metric_code", "quantity_kind", "base_unit", "source_key", "reference_year", "status")


def entities_valid(s: SparkSession, d: str) -> DataFrame:
    """Entities valid on a day. #22, #23"""
    return t(s, d, "entity").where(holds(c("valid_from"), c("valid_to"), F.lit("2000-01-01").cast("date"))).select("source_key", "label")


#: The checks a release declares.
DECLARED = ["claim_without_file", "claim_without_entity", "claim_without_metric", "period_after_edition", "unparsed_without_code", "unit_contradicts_currency", "repeated_claim", "value_outside_expected_range", "value_contradicts_unit", "size_mismatch", "boundary_overlap"]
#: Totals expected of orders by priority: an inline relation; a null bound is open.
BOUNDS = [("1-URGENT", 1000.0, 400000.0), ("2-HIGH", None, 350000.0), ("3-MEDIUM", 2000.0, None)]


def _checks(s: SparkSession, d: str) -> list[quality.Check]:
    p, a, e, m = (t(s, d, n) for n in ("parsed_value", "artifact", "entity", "metric"))
    key = c("parsed_value_id")
    return [
        quality.Check("claim_without_file", "error", quality.orphans(p, a, ["dataset_code", "edition_year"]), key, gate=True),
        quality.Check("claim_without_entity", "warning", quality.orphans(p, e, ["source_key"]), key),
        quality.Check("claim_without_metric", "error", quality.orphans(p, m, ["metric_code"]), key, gate=True),
        quality.Check("period_after_edition", "warning", p.where("reference_year > edition_year + 1"), key),
        quality.Check("unparsed_without_code", "warning", p.where("status = 'unparsed' and failure_code is null"), key),
        quality.Check("unit_contradicts_currency", "warning", p.where("currency is not null and unit_hint is not null"), key),
        quality.Check("repeated_claim", "info", quality.not_unique(p, ["dataset_code", "source_key", "metric_code", "reference_year", "edition_year", "raw"]), F.concat_ws("/", "dataset_code", "source_key", "metric_code", c("reference_year").cast("string"), c("edition_year").cast("string"), "raw")),
        quality.Check("value_outside_expected_range", "warning", _outside(s, d), c("o_orderkey")),
        quality.Check("value_contradicts_unit", "warning", _contradicting(s, d), c("p_partkey")),
        quality.Check("size_mismatch", "error", t(s, d, "documents").where("n_chars <> length(text)"), c("doc_id"), gate=True),
    ]


def _outside(s: SparkSession, d: str) -> DataFrame:
    bounds = s.createDataFrame(BOUNDS, "o_orderpriority string, low double, high double")
    return quality.outside_range(t(s, d, "orders").select("o_orderkey", "o_orderpriority", c("o_totalprice").cast("double").alias("value")), bounds, "o_orderpriority", "value")


def _contradicting(s: SparkSession, d: str) -> DataFrame:
    p = t(s, d, "part").select("p_partkey", c("p_retailprice").cast("double").alias("price"), "p_size")
    raw = F.when(c("p_size") % 5 == 0, F.concat(F.lit("$"), c("p_size").cast("string"), F.lit("%"))).when(c("p_size") % 5 == 1, (c("p_size") + 1985).cast("string")).otherwise(F.concat((c("p_size") + 1985).cast("string"), F.lit(" km")))
    v = values.parse_value(p.withColumn("raw", raw), "raw", "v").select("p_partkey", "v.value", "v.is_percent", "v.currency", "v.unit_hint")
    return quality.contradicts_unit(v, "value", "is_percent", "currency", "unit_hint")


def quality_findings(s: SparkSession, d: str) -> DataFrame:
    """The suite over claims, files, orders and texts: findings, severity and gate of each check. #149, #150, #152–#155, #157, #158"""
    return quality.run(_checks(s, d))


def value_outside_range(s: SparkSession, d: str) -> DataFrame:
    """Orders whose total lies outside the range of their priority. #48, #153"""
    return _outside(s, d).select("o_orderkey", "o_orderpriority", "value")


def value_contradicts_unit(s: SparkSession, d: str) -> DataFrame:
    """Quantities that don't go with their unit: "$5%", or a bare year. #154"""
    return _contradicting(s, d).select("p_partkey", c("value").cast("double").alias("value"), "is_percent", "currency")


def parser_coverage(s: SparkSession, d: str) -> DataFrame:
    """How many claims a parser has read: one info row. #156"""
    return quality.coverage(t(s, d, "parsed_value"), c("status").isNotNull() & (c("status") != "unparsed"))


def checks_declared(s: SparkSession, d: str) -> DataFrame:
    """Checks declared without code, or the other way round. #159"""
    return quality.undeclared(DECLARED, _checks(s, d), s)


def quality_gate(s: SparkSession, d: str) -> DataFrame:
    """Whether the release is refused: only the gates are evaluated. #160"""
    return quality.gate_failed(quality.run([x for x in _checks(s, d) if x.gate and x.severity == "error"], 0))


def qualified_fields(s: SparkSession, d: str) -> DataFrame:
    """Fields named with their subfield, and how many there are. #114"""
    return t(s, d, "raw_field").groupBy(values.qualified(c("field_name"), c("subfield_name")).alias("label")).agg(F.count("*").alias("fields"))


def one_way_relations(s: SparkSession, d: str) -> DataFrame:
    """Pairs of nations that trade one way only: a relation without its reverse, or with itself. #163"""
    n = t(s, d, "nation").select("n_nationkey", "n_regionkey")
    edges = n.join(n.select(c("n_nationkey").alias("to"), c("n_regionkey").alias("r2")), (c("n_regionkey") == c("r2")) & ((c("n_nationkey") * 7 + c("to")) % 3 == 0)).select(c("n_nationkey").alias("a"), c("to").alias("b"))
    back = edges.select(c("a").alias("b"), c("b").alias("a"))
    return edges.join(back, ["a", "b"], "left_anti").withColumn("fault", F.lit("not_symmetric")).unionByName(edges.where("a = b").withColumn("fault", F.lit("self")))


def share_sum_check(s: SparkSession, d: str) -> DataFrame:
    """Compositions whose shares are off 100 by more than 25. #61, #151"""
    f = t(s, d, "raw_field").where(c("field_name").isin("Ethnic groups", "Religions")).select("field_value_id", "raw_text")
    m = values.parse_shares(f, "raw_text").select("field_value_id", F.explode("members").alias("m"))
    g = m.groupBy("field_value_id").agg(F.sum("m.share_percent").alias("total"), F.count("m.share_percent").alias("shares"))
    return g.where((c("shares") > 0) & (F.abs(c("total") - 100) > 25)).select("field_value_id", c("total").cast("double").alias("total"), "shares")


def reconciliation(s: SparkSession, d: str) -> DataFrame:
    """Fields of each file beside those that are staged once, where they differ. #66, #157"""
    f = t(s, d, "raw_field")
    reported = f.groupBy("artifact_id").agg(F.count("*").alias("n"))
    actual = f.groupBy("artifact_id", "record_id", "section_name", "field_name", "subfield_name", "ordinal", "raw_text").agg(F.lit(1)).groupBy("artifact_id").agg(F.count("*").alias("n"))
    return quality.reconcile(reported, actual, "artifact_id")


def edition_coverage(s: SparkSession, d: str) -> DataFrame:
    """Claims, entities and parsed share of each edition. #57, #65"""
    return t(s, d, "parsed_value").groupBy("edition_year").agg(F.count("*").alias("claims"), F.count_distinct("source_key").alias("entities"), F.count_if(c("status") != "unparsed").alias("parsed"), F.max("reference_year").alias("last_year"))


def line_constraints(s: SparkSession, d: str) -> DataFrame:
    """Rules broken by lines, in one pass. #28, §1.3"""
    rules = {"discount_range": c("l_discount").between(0, 0.05), "tax_range": c("l_tax") <= 0.05, "quantity_positive": c("l_quantity") > 0, "returned_is_final": (c("l_returnflag") != "R") | (c("l_linestatus") == "F")}
    return quality.violations(t(s, d, "lineitem"), rules, c("l_orderkey")).groupBy("rule").agg(F.count("*").alias("lines"))


def topic_trees(s: SparkSession, d: str) -> DataFrame:
    """First element of a dotted path. §1.1 taxonomy"""
    return t(s, d, "metric").select("metric_code", F.element_at(F.split("metric_code", r"\."), 1).alias("domain")).groupBy("domain").agg(F.count("*").alias("metrics"))


def slugs(s: SparkSession, d: str) -> DataFrame:
    """Slugs of labels. #113"""
    return t(s, d, "entity").select("source_key", values.slugify(c("label")).alias("slug"))


def list_markers(s: SparkSession, d: str) -> DataFrame:
    """Names escaped for tables and as anchors. #129"""
    return _items(s, d).select("item_id", tx.escape_pipes(F.concat_ws(" | ", "topic", "country")).alias("cell"))


def czech_order(s: SparkSession, d: str) -> DataFrame:
    """Labels in a locale's order, within their region. #95"""
    w = Window.partitionBy("region_name").orderBy(F.collate("label", "cs"), "source_key")
    return t(s, d, "entity").where("label is not null").select("source_key", "region_name", F.row_number().over(w).alias("place"))


def headline_metrics(s: SparkSession, d: str) -> DataFrame:
    """The catalogue in one row. #169"""
    i, a = _items(s, d), F.lower("attrs")
    return i.agg(F.count("*").alias("items"), F.count_if(a.rlike(r"data\s*[=:]\s*(api|bulk|ogc)")).alias("machine_readable"), F.count_if(a.rlike(r"kind\s*[=:]\s*official")).alias("official"), F.date_format(F.max("verified_on"), "yyyy-MM-dd").alias("last_verified"), F.count_distinct("country").alias("countries"))


def payload_topics(s: SparkSession, d: str) -> DataFrame:
    """Topics a country's items use, with stable ordinals. #168"""
    used = _items(s, d).where("country = 'EU'")
    topics, _ = catalogue.shaped(used, _items(s, d).select("topic").distinct(), _items(s, d).select("topic", c("topic").alias("related")).limit(0))
    return topics.join(used.groupBy("topic").agg(F.count("*").alias("items")), "topic").select("topic", "ordinal", "items")


def narrative_search(s: SparkSession, d: str) -> DataFrame:
    """Documents with all words of a query, with their title, section, entity and region. #118"""
    docs = t(s, d, "documents")
    hits = search.all_terms(search.inverted_index(docs, "doc_id", c("text")), "doc_id", search.query_terms(s, "treaties on borders"))
    return hits.join(docs.select("doc_id", "title", "section_name", "source_key"), "doc_id").join(t(s, d, "entity").select("source_key", "label", "region_name"), "source_key", "left").select("doc_id", "rank", "title", "section_name", "label", "region_name")


def artifact_selection(s: SparkSession, d: str) -> DataFrame:
    """Files chosen by year and family together. #3"""
    return manifest.select(t(s, d, "artifact"), years=[2000, 2001, 2002], families=["html_pages", "json_cache"]).select("artifact_id", "dataset_code", "edition_year", "parser_family")


def ingestion_status(s: SparkSession, d: str) -> DataFrame:
    """Fields and entries staged of each file. #26, #131"""
    g = t(s, d, "raw_field").groupBy("artifact_id").agg(F.count("field_value_id").alias("fields"), F.count_distinct("record_id").alias("entries"))
    joined = t(s, d, "artifact").select("artifact_id", "parser_family").join(g, "artifact_id", "left").na.fill(0, ["fields", "entries"])
    return joined.withColumn("staged", c("fields") > 0)


def repaired_names(s: SparkSession, d: str) -> DataFrame:
    """Entities without a region named by their most used title. #135"""
    m = relational.modal(t(s, d, "documents").where("source_key is not null"), ["source_key"], "title")
    e = t(s, d, "entity").join(m, "source_key", "left")
    return e.select("source_key", F.when(c("region_name").isNull(), F.coalesce("title", "label")).otherwise(c("label")).alias("name"))


_HOST = r"regexp_replace(lower(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1)), '^www\.', '')"
_PATH = r"regexp_extract(regexp_replace(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*', ''), '^([^?#]*)', 1)"
_U = f"(SELECT item_id, country, topic, url, verified_on, {_HOST} AS domain, {_PATH} AS path, regexp_extract(url, '\\?([^#]*)', 1) AS q FROM (SELECT * REPLACE (trim(url) AS url) FROM catalogue_item) WHERE url IS NOT NULL)"
_RAW = _U.replace("(SELECT * REPLACE (trim(url) AS url) FROM catalogue_item)", "catalogue_item")
_TOKENS = r"regexp_extract_all(lower({0}), '[\p{{L}}\p{{N}}]+')"


def _grams(text: str) -> str:
    words = _TOKENS.format(text)
    return f"list_distinct(flatten(list_transform({words}, lambda w: list_transform(range(1, length(w) + 2), lambda i: substr('  ' || w || ' ', i, 3)))))"


_STOP = ", ".join(f"'{w}'" for w in tx.STOPWORDS)
_STEM = """CASE WHEN length(w) <= 3 THEN w ELSE CASE WHEN length(p) > 5 AND regexp_matches(p, '[aeiou].*ing$') THEN regexp_replace(p, 'ing$', '') WHEN length(p) > 4 AND regexp_matches(p, '[aeiou].*ed$') THEN regexp_replace(p, 'ed$', '') ELSE p END END"""
_INDEX = f"""WITH w AS (SELECT doc_id, unnest({_TOKENS.format('text')}) AS w FROM documents), f AS (SELECT * FROM w WHERE w NOT IN ({_STOP})),
p AS (SELECT doc_id, w, CASE WHEN regexp_matches(w, '(ss|us|is)$') THEN w WHEN regexp_matches(w, 'ies$') THEN regexp_replace(w, 'ies$', 'y') WHEN regexp_matches(w, '(sh|ch|x|z|ss)es$') THEN regexp_replace(w, 'es$', '') ELSE regexp_replace(w, 's$', '') END AS p FROM f),
x AS (SELECT doc_id, {_STEM} AS term FROM p), n AS (SELECT doc_id, count(*) AS size FROM x GROUP BY 1), g AS (SELECT doc_id, term, count(*) AS tf FROM x GROUP BY ALL)"""
_AGE = f"date_diff('day', verified_on, DATE '{AS_OF}')"

NAMES = (
    facet_counts, coverage_grid, topic_rollup, value_counts, supra_counts, catalogue_filter, holes, related_topics, catalogue_order, page_two, url_keys, url_scrubbed, url_evidence, domain_stats, deep_domains, sanitise_classes, source_label, freshness, link_states, catalogue_faults, repeated_urls,
    fuzzy_names, fuzzy_pairs, text_search, text_top10, set_operations, customers_without, orders_returned, file_differences, ordered_fingerprint, json_props, totals_row, dim_period, dim_entity, fact_observation, entities_valid, quality_findings, quality_gate, value_outside_range, value_contradicts_unit, parser_coverage, checks_declared, qualified_fields, one_way_relations, share_sum_check, reconciliation, edition_coverage,
    line_constraints, topic_trees, slugs, list_markers, czech_order, headline_metrics, payload_topics, narrative_search, artifact_selection, ingestion_status, repaired_names,
)
QUERIES = {f.__name__: f for f in NAMES}
_TOPIC_LIST = ", ".join(f"'{x}'" for x in TOPICS)
_CHECK = "SELECT {0} AS check_name, {1} AS severity, {2} AS gate, count(*) AS findings, coalesce(array_to_string(list_sort(list_sort(list(k))[1:5]), ','), '') AS sample FROM (SELECT CAST({3} AS VARCHAR) AS k FROM {4})"
_OUTSIDE = "SELECT o_orderkey, o_orderpriority, CAST(o_totalprice AS DOUBLE) AS value FROM orders JOIN (VALUES ('1-URGENT', 1000.0, 400000.0), ('2-HIGH', NULL, 350000.0), ('3-MEDIUM', 2000.0, NULL)) b(o_orderpriority, low, high) USING (o_orderpriority) WHERE o_totalprice < low OR o_totalprice > high"
_CONTRADICTING = "SELECT p_partkey, CAST(CASE WHEN p_size % 5 = 0 THEN p_size ELSE p_size + 1985 END AS DOUBLE) AS value, p_size % 5 = 0 AS is_percent, CASE WHEN p_size % 5 = 0 THEN 'USD' END AS currency FROM part WHERE p_size % 5 = 0 OR p_size % 5 = 1 AND p_size + 1985 BETWEEN 1990 AND 2025"
_CHECKS = " UNION ALL ".join(
    _CHECK.format(f"'{n}'", f"'{sev}'", gate, key, rows)
    for n, sev, gate, key, rows in (
        ("claim_without_file", "error", "true", "parsed_value_id", "parsed_value p WHERE NOT EXISTS (SELECT 1 FROM artifact a WHERE a.dataset_code = p.dataset_code AND a.edition_year = p.edition_year) AND dataset_code IS NOT NULL AND edition_year IS NOT NULL"),
        ("claim_without_entity", "warning", "false", "parsed_value_id", "parsed_value p WHERE source_key IS NOT NULL AND source_key NOT IN (SELECT source_key FROM entity WHERE source_key IS NOT NULL)"),
        ("claim_without_metric", "error", "true", "parsed_value_id", "parsed_value p WHERE metric_code IS NOT NULL AND metric_code NOT IN (SELECT metric_code FROM metric WHERE metric_code IS NOT NULL)"),
        ("period_after_edition", "warning", "false", "parsed_value_id", "parsed_value WHERE reference_year > edition_year + 1"),
        ("unparsed_without_code", "warning", "false", "parsed_value_id", "parsed_value WHERE status = 'unparsed' AND failure_code IS NULL"),
        ("unit_contradicts_currency", "warning", "false", "parsed_value_id", "parsed_value WHERE currency IS NOT NULL AND unit_hint IS NOT NULL"),
        ("repeated_claim", "info", "false", "concat_ws('/', dataset_code, source_key, metric_code, reference_year, edition_year, raw)", "(SELECT dataset_code, source_key, metric_code, reference_year, edition_year, raw FROM parsed_value GROUP BY ALL HAVING count(*) > 1)"),
        ("value_outside_expected_range", "warning", "false", "o_orderkey", f"({_OUTSIDE})"),
        ("value_contradicts_unit", "warning", "false", "p_partkey", f"({_CONTRADICTING})"),
        ("size_mismatch", "error", "true", "doc_id", "documents WHERE n_chars <> length(text)"),
    )
)
SQL = {
    "facet_counts": " UNION ALL ".join(f"SELECT '{a}' AS axis, {a} AS value, CAST(sum(CASE WHEN {w} THEN 1 ELSE 0 END) AS BIGINT) AS items FROM documents WHERE {a} IS NOT NULL GROUP BY {a}" for a, w in (("lang", "source IN ('archive_text', 'gazetteer')"), ("source", "lang IN ('en', 'fr')"), ("section_name", "lang IN ('en', 'fr') AND source IN ('archive_text', 'gazetteer')"))),
    "coverage_grid": "SELECT country, " + ", ".join(f"count(*) FILTER (WHERE topic = '{x}') AS topic_{x}" for x in TOPICS) + f", count(*) FILTER (WHERE topic NOT IN ({_TOPIC_LIST}) OR topic IS NULL) AS topic_other, count(*) AS total FROM catalogue_item GROUP BY country",
    "topic_rollup": r"SELECT topic, count(*) AS items, count(DISTINCT country) AS members, round(avg(CAST(regexp_matches(lower(attrs), 'kind\s*[=:]\s*official') AS INT)), 6) AS official_share, round(avg(CAST(regexp_matches(lower(attrs), 'data\s*[=:]\s*(api|bulk|ogc)') AS INT)), 6) AS machine_share FROM catalogue_item GROUP BY topic",
    "value_counts": "SELECT country, count(*) AS items, min(item_id) AS first_seen FROM catalogue_item GROUP BY country",
    "supra_counts": "SELECT topic, count(*) FILTER (WHERE country = 'EU') AS union_items, count(*) FILTER (WHERE country <> 'EU') AS national_items FROM catalogue_item GROUP BY topic",
    "catalogue_filter": f"SELECT item_id, topic, name FROM catalogue_item WHERE country = 'EU' AND topic IN ('courts', 'water') AND contains(lower(concat_ws(' ', name, {_HOST}, descr)), 'harbour')",
    "holes": "SELECT a.country, b.topic FROM (SELECT DISTINCT country FROM catalogue_item) a CROSS JOIN (SELECT DISTINCT topic FROM catalogue_item) b WHERE NOT EXISTS (SELECT 1 FROM catalogue_item i WHERE i.country = a.country AND i.topic = b.topic) AND NOT (b.topic = 'geology' AND a.country IN (SELECT country FROM catalogue_item WHERE topic = 'water'))",
    "related_topics": f"WITH u AS (SELECT DISTINCT topic, domain FROM {_U}), e AS (SELECT DISTINCT a.topic, b.topic AS related FROM u a JOIN u b USING (domain) WHERE a.topic < b.topic) SELECT e.topic, e.related, n.items FROM e JOIN (SELECT topic AS related, count(*) AS items FROM catalogue_item WHERE country = 'EU' GROUP BY 1) n USING (related)",
    "catalogue_order": "SELECT item_id, topic, CAST(row_number() OVER (PARTITION BY topic ORDER BY country, source_file, item_id) AS INT) AS place FROM catalogue_item",
    "page_two": "SELECT item_id, name FROM catalogue_item ORDER BY item_id LIMIT 50 OFFSET 50",
    "url_keys": f"SELECT item_id, domain, domain || regexp_replace(path, '/+$', '') || CASE WHEN q <> '' THEN '?' || q ELSE '' END AS same_place, domain || regexp_replace(path, '/+$', '') AS canonical, lower(domain || regexp_replace(path, '/+$', '')) AS norm, regexp_replace(path, '/+$', '') = '' AND q = '' AS is_root FROM {_U}",
    "url_scrubbed": "SELECT item_id, regexp_replace(url, '[?#].*$', '') AS url FROM catalogue_item WHERE url IS NOT NULL",
    "url_evidence": f"WITH u AS (SELECT item_id, domain, lower(path) AS path FROM {_U}), r AS (SELECT domain, arg_min(regexp_extract(path, '^(/[^/]+)', 1), item_id) AS root_path FROM u GROUP BY domain) SELECT u.item_id, u.domain, r.root_path FROM u JOIN r USING (domain) WHERE r.root_path = '' OR u.path = r.root_path OR starts_with(u.path, r.root_path || '/')",
    "domain_stats": f"SELECT domain, count(*) AS items, count(DISTINCT url) AS urls, strftime(max(verified_on), '%Y-%m-%d') AS last_verified, substr(min(url), 1, 150) AS first_url FROM {_RAW} GROUP BY domain",
    "deep_domains": f"SELECT country, domain, bool_or(regexp_replace(path, '/+$', '') = '' AND q = '') AS has_root, count(*) FILTER (WHERE NOT (regexp_replace(path, '/+$', '') = '' AND q = '')) AS deep FROM {_U} GROUP BY ALL HAVING count(*) FILTER (WHERE NOT (regexp_replace(path, '/+$', '') = '' AND q = '')) >= 4",
    "sanitise_classes": r"SELECT item_id, CASE WHEN regexp_matches(h, '(?i)^https?://(localhost|127\.|10\.|192\.168\.)') THEN 'infrastructure' WHEN regexp_matches(h, '(?i)health|court') THEN 'sensitive' WHEN regexp_matches(h, '(?i)kind\s*[=:]\s*regional') THEN 'regional' ELSE 'keep' END AS class FROM (SELECT item_id, concat_ws(' ', url, topic, attrs) AS h FROM catalogue_item)",
    "source_label": "SELECT country, concat_ws('+', CASE WHEN count(url) > 0 THEN 'url' END, CASE WHEN count(verified_on) > 0 THEN 'verified' END) AS evidence FROM catalogue_item GROUP BY country",
    "freshness": f"SELECT item_id, CAST({_AGE} AS INT) AS age_days, CASE WHEN verified_on IS NULL THEN 'missing' WHEN {_AGE} < -1 THEN 'error' WHEN {_AGE} > 730 THEN 'warning' ELSE 'ok' END AS state FROM catalogue_item",
    "link_states": "WITH p AS (SELECT ([200, 301, 403, 404, 500, NULL, 410, 200])[item_id % 8 + 1] AS a, ([200, 301, 403, 404, 500, NULL, 410, 200])[(item_id * 3) % 8 + 1] AS b, ([200, 301, 403, 404, 500, NULL, 410, 200])[(item_id * 5) % 8 + 1] AS x FROM catalogue_item) SELECT CASE WHEN coalesce(a BETWEEN 200 AND 399, false) OR coalesce(b BETWEEN 200 AND 399, false) THEN 'ok' WHEN coalesce(x BETWEEN 200 AND 399, false) THEN 'certificate' WHEN coalesce(b, a) IN (401, 403, 405, 429) THEN 'restricted' WHEN coalesce(b, a) IN (404, 410) THEN 'dead' WHEN coalesce(b, a) >= 500 THEN 'server_error' ELSE 'unreachable' END AS state, count(*) AS links FROM p GROUP BY 1",
    "catalogue_faults": f"SELECT rule, count(*) AS items FROM (SELECT 'no_url' AS rule FROM catalogue_item WHERE url IS NULL UNION ALL SELECT 'short_description' FROM catalogue_item WHERE length(descr) < 60 UNION ALL SELECT 'no_description' FROM catalogue_item WHERE descr IS NULL UNION ALL SELECT 'not_https' FROM catalogue_item WHERE NOT starts_with(url, 'https://') UNION ALL SELECT 'late' FROM catalogue_item WHERE verified_on > DATE '{AS_OF}') GROUP BY rule",
    "repeated_urls": "SELECT url, count(*) AS items FROM catalogue_item WHERE url IS NOT NULL GROUP BY url HAVING count(*) > 1",
    "fuzzy_names": f"WITH g AS (SELECT source_key, label, {_grams('label')} AS a, {_grams(chr(39) + 'Stouxsiasvick' + chr(39))} AS b FROM entity WHERE label IS NOT NULL), r AS (SELECT source_key, label, round(len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b)))::DOUBLE, 6) AS similarity FROM g) SELECT * FROM r WHERE similarity > 0.3 ORDER BY similarity DESC, source_key LIMIT 10",
    "fuzzy_pairs": f"WITH g AS (SELECT source_key, {_grams('label')} AS a FROM entity WHERE label IS NOT NULL), r AS (SELECT x.source_key AS source_key_left, y.source_key AS source_key_right, round(len(list_intersect(x.a, y.a)) / len(list_distinct(list_concat(x.a, y.a)))::DOUBLE, 6) AS similarity FROM g x JOIN g y ON x.source_key < y.source_key) SELECT * FROM r WHERE similarity > 0.3",
    "text_search": f"{_INDEX} SELECT g.doc_id, round(sum(tf) / (1 + ln(any_value(size)::DOUBLE)), 6) AS rank FROM g JOIN n USING (doc_id) WHERE term IN ('harbour', 'ferry') GROUP BY g.doc_id HAVING count(*) = 2",
    "text_top10": f"{_INDEX} SELECT g.doc_id, round(sum(tf) / (1 + ln(any_value(size)::DOUBLE)), 6) AS rank FROM g JOIN n USING (doc_id) WHERE term = 'water' GROUP BY g.doc_id ORDER BY 2 DESC, 1 LIMIT 10",
    "set_operations": "WITH a AS (SELECT DISTINCT o_custkey FROM orders WHERE year(o_orderdate) = 1996), b AS (SELECT DISTINCT o_custkey FROM orders WHERE year(o_orderdate) = 1997) SELECT o_custkey, 'difference' AS part FROM (FROM a EXCEPT ALL FROM b) UNION ALL SELECT o_custkey, 'intersection' FROM (FROM a INTERSECT FROM b) UNION ALL SELECT o_custkey, 'union' FROM (FROM a UNION FROM b)",
    "customers_without": "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE year(o_orderdate) = 1996)",
    "orders_returned": "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')",
    "file_differences": "SELECT coalesce(p.dataset_code, a.dataset_code) AS dataset_code, CASE WHEN p.dataset_code IS NULL THEN 'files only' WHEN a.dataset_code IS NULL THEN 'claims only' ELSE 'both' END AS side FROM (SELECT DISTINCT dataset_code FROM parsed_value) p FULL JOIN (SELECT DISTINCT dataset_code FROM artifact) a ON p.dataset_code = a.dataset_code",
    "ordered_fingerprint": "SELECT quantity_kind, md5(string_agg(x, ',' ORDER BY x)) AS fingerprint FROM (SELECT quantity_kind, unit_code || ':' || unit_label AS x FROM unit_reference) GROUP BY quantity_kind",
    "headline_metrics": r"SELECT count(*) AS items, count(*) FILTER (WHERE regexp_matches(lower(attrs), 'data\s*[=:]\s*(api|bulk|ogc)')) AS machine_readable, count(*) FILTER (WHERE regexp_matches(lower(attrs), 'kind\s*[=:]\s*official')) AS official, strftime(max(verified_on), '%Y-%m-%d') AS last_verified, count(DISTINCT country) AS countries FROM catalogue_item",
    "payload_topics": "SELECT topic, CAST(row_number() OVER (ORDER BY topic) - 1 AS INT) AS ordinal, items FROM (SELECT topic, count(*) AS items FROM catalogue_item WHERE country = 'EU' GROUP BY topic)",
    "narrative_search": f"{_INDEX}, h AS (SELECT g.doc_id, round(sum(tf) / (1 + ln(any_value(size)::DOUBLE)), 6) AS rank FROM g JOIN n USING (doc_id) WHERE term IN ('border', 'treaty') GROUP BY g.doc_id HAVING count(*) = 2) SELECT h.doc_id, h.rank, d.title, d.section_name, e.label, e.region_name FROM h JOIN documents d USING (doc_id) LEFT JOIN entity e USING (source_key)",
    "artifact_selection": "SELECT artifact_id, dataset_code, edition_year, parser_family FROM artifact WHERE edition_year IN (2000, 2001, 2002) AND parser_family IN ('html_pages', 'json_cache')",
    "ingestion_status": "SELECT a.artifact_id, a.parser_family, count(r.field_value_id) AS fields, count(DISTINCT r.record_id) AS entries, count(r.field_value_id) > 0 AS staged FROM artifact a LEFT JOIN raw_field r USING (artifact_id) GROUP BY ALL",
    "repaired_names": "WITH g AS (SELECT source_key, title, count(*) AS uses FROM documents WHERE title IS NOT NULL AND source_key IS NOT NULL GROUP BY ALL), m AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_key ORDER BY uses DESC, length(title) DESC, title) AS rn FROM g) WHERE rn = 1) SELECT e.source_key, CASE WHEN e.region_name IS NULL THEN coalesce(m.title, e.label) ELSE e.label END AS name FROM entity e LEFT JOIN m USING (source_key)",
    "json_props": "SELECT event_type, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS k, count(json_extract_string(props, '$.k')) AS events FROM events GROUP BY event_type",
    "totals_row": " UNION ALL ".join(f"SELECT '{n}' AS name, count(*) AS rows FROM {n}" for n in ("entity", "metric", "artifact", "raw_field", "parsed_value", "raw_line", "catalogue_item", "documents")),
    "dim_period": "SELECT CAST(year(m) * 100 + month(m) AS INT) AS period_key, CAST(year(m) AS INT) AS year, CAST(quarter(m) AS INT) AS quarter, CAST(month(m) AS INT) AS month, strftime(m, '%Y-%m') AS label FROM (SELECT unnest(generate_series(date_trunc('month', min(o_orderdate)), date_trunc('month', max(o_orderdate)), INTERVAL 1 MONTH)) AS m FROM orders)",
    "dim_entity": "SELECT source_key, coalesce(nullif(trim(label), ''), upper(source_key), 'unnamed') AS entity_name, coalesce(region_name, 'unknown') AS region, valid_to IS NULL AS is_current FROM entity",
    "fact_observation": "SELECT parsed_value_id, metric_code, quantity_kind, base_unit, source_key, reference_year, status FROM parsed_value JOIN metric USING (metric_code) WHERE quantity_kind IN ('area', 'length')",
    "entities_valid": "SELECT source_key, label FROM entity WHERE coalesce(valid_from, DATE '0001-01-01') <= DATE '2000-01-01' AND DATE '2000-01-01' < coalesce(valid_to, DATE '9999-12-31')",
    "quality_findings": _CHECKS,
    "value_outside_range": _OUTSIDE,
    "value_contradicts_unit": _CONTRADICTING,
    "parser_coverage": "SELECT 'parser_coverage' AS check_name, 'info' AS severity, count(*) FILTER (WHERE status <> 'unparsed') AS parsed, count(*) AS total, coalesce(round(count(*) FILTER (WHERE status <> 'unparsed') / count(*), 6), 0) AS share FROM parsed_value",
    "checks_declared": "SELECT 'boundary_overlap' AS check_name, 'declared_only' AS state",
    "qualified_fields": "SELECT CASE WHEN trim(coalesce(subfield_name, '')) = '' THEN coalesce(field_name, '') WHEN field_name IS NULL THEN trim(subfield_name) ELSE field_name || ' / ' || trim(subfield_name) END AS label, count(*) AS fields FROM raw_field GROUP BY 1",
    "one_way_relations": "WITH e AS (SELECT x.n_nationkey AS a, y.n_nationkey AS b FROM nation x JOIN nation y ON x.n_regionkey = y.n_regionkey AND (x.n_nationkey * 7 + y.n_nationkey) % 3 = 0) SELECT a, b, 'not_symmetric' AS fault FROM e WHERE NOT EXISTS (SELECT 1 FROM e f WHERE f.a = e.b AND f.b = e.a) UNION ALL SELECT a, b, 'self' FROM e WHERE a = b",
    "quality_gate": f"SELECT coalesce(bool_or(severity = 'error' AND gate AND findings > 0), false) AS refused FROM ({_CHECKS})",
    "reconciliation": "WITH r AS (SELECT artifact_id, count(*) AS reported FROM raw_field GROUP BY 1), a AS (SELECT artifact_id, count(*) AS actual FROM (SELECT DISTINCT artifact_id, record_id, section_name, field_name, subfield_name, ordinal, raw_text FROM raw_field) GROUP BY 1) SELECT artifact_id, reported, actual, actual - reported AS difference FROM r JOIN a USING (artifact_id) WHERE actual <> reported",
    "edition_coverage": "SELECT edition_year, count(*) AS claims, count(DISTINCT source_key) AS entities, count(*) FILTER (WHERE status <> 'unparsed') AS parsed, max(reference_year) AS last_year FROM parsed_value GROUP BY 1",
    "line_constraints": "SELECT rule, count(*) AS lines FROM (SELECT 'discount_range' AS rule FROM lineitem WHERE NOT l_discount BETWEEN 0 AND 0.05 UNION ALL SELECT 'tax_range' FROM lineitem WHERE l_tax > 0.05 UNION ALL SELECT 'quantity_positive' FROM lineitem WHERE l_quantity <= 0 UNION ALL SELECT 'returned_is_final' FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus <> 'F') GROUP BY rule",
    "topic_trees": "SELECT string_split(metric_code, '.')[1] AS domain, count(*) AS metrics FROM metric GROUP BY 1",
    "slugs": r"SELECT source_key, substr(regexp_replace(regexp_replace(lower(strip_accents(label)), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 1, 80) AS slug FROM entity",
    "list_markers": r"SELECT item_id, topic || ' \| ' || country AS cell FROM catalogue_item",
}
