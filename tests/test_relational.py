import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import claims, facets, load, quality, relational, resolve, search


def test_merge_and_insert(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    new = spark.createDataFrame([(2, "B"), (3, None), (None, "N")], "k int, v string")
    assert sorted(map(tuple, relational.merge_upsert(old, new, ["k"]).collect()), key=str) == sorted([(1, "a"), (2, "B"), (3, None), (None, "N")], key=str)
    assert sorted(map(tuple, relational.insert_new(old.dropna(), new.dropna(subset=["k"]).unionByName(new.where("k = 3")), ["k"], [F.asc("v")]).collect()), key=str) == sorted([(1, "a"), (2, "b"), (3, None)], key=str)
    assert relational.merge_upsert(old.where("false"), new.where("false"), ["k"]).count() == 0


def test_modal_ties(spark):
    df = spark.createDataFrame([("x", "bb"), ("x", "aa"), ("x", "c"), ("y", None), ("y", "z")], "k string, v string")
    assert sorted((r.k, r.v) for r in relational.modal(df, ["k"], "v").collect()) == [("x", "aa"), ("y", "z")]


def test_tiers(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "k string")
    first = spark.createDataFrame([("a", 1), ("b", 1), ("b", 2)], "k string, e int")
    second = spark.createDataFrame([("a", 9), ("c", 3)], "k string, e int")
    got = {r.k: (r.tier, r.matches, r.e) for r in relational.tiered(df, [("code", first), ("name", second)], "k", "e").collect()}
    assert got == {"a": ("code", 1, 1), "b": ("code", 2, None), "c": ("name", 1, 3), None: (None, 0, None)}


def test_resolution(spark):
    e = spark.createDataFrame([("E1", "cs", "Old Land", None, "1993-01-01"), ("E2", "ez", "New Land", "1993-01-01", None), ("E3", "cs", "Later", "2000-01-01", None), ("E4", "x", "New Land", "2010-01-01", None)], "entity_key string, code string, name string, a string, b string").selectExpr("entity_key", "code", "name", "cast(a as date) valid_from", "cast(b as date) valid_to")
    k = spark.createDataFrame([("CS ", "?", "1990-01-01", "1991-01-01"), ("cs", "?", "1994-01-01", "1995-01-01"), ("?", " new LAND", "1995-01-01", "1996-01-01"), ("?", "New Land", "2011-01-01", "2012-01-01"), (None, None, None, None)], "source_key string, label string, a string, b string").selectExpr("source_key", "label", "cast(a as date) `from`", "cast(b as date) `to`")
    got = sorted((str(r.source_key), str(r["from"]), r.tier, r.entity_key) for r in resolve.resolve(k, e).collect())
    assert got == [("?", "1995-01-01", "name", "E2"), ("?", "2011-01-01", "ambiguous", None), ("CS ", "1990-01-01", "code", "E1"), ("None", "None", "unresolved", None), ("cs", "1994-01-01", "unresolved", None)]
    curated = spark.createDataFrame([("cs", "E9")], "source_key string, entity_key string")
    assert {r.tier for r in resolve.keep_curated(resolve.resolve(k, e), curated).where("source_key = 'cs'").collect()} == {"curated"}
    u = spark.createDataFrame([("aa", "Côte"), ("aa", "Côte"), ("aa", "Z"), ("bb", "cote"), ("cc", None)], "source_key string, label string")
    assert {r.source_key: r.slug for r in resolve.bootstrap(u, spark.createDataFrame([("cc",)], "slug string")).collect()} == {"aa": "cote", "bb": "cote-bb", "cc": "cc-cc"}


def test_claims(spark):
    df = spark.createDataFrame([(1, "e", "m", 2000, 2001, 5.0), (2, "e", "m", 2000, 2002, 6.0), (3, "e", "m", None, 2003, 7.0), (4, "e", "m", 2000, 2002, 6.0), (5, "f", "m", 2001, 2002, None)], "id int, entity string, metric string, year int, edition int, value double")
    assert {r.entity: r.id for r in claims.latest(df, ["entity", "metric"], ["year", "edition"], "id").collect()} == {"e": 4, "f": 5}
    assert {r.entity: r.id for r in claims.latest(df, ["entity", "metric"], ["edition", "year"], "id").collect()} == {"e": 3, "f": 5}
    grouped = claims.source_claims(df.withColumn("d", F.lit("x")), ["entity", "metric", "year"], "value", "d", "edition")
    assert [(r.entity, r.year, r.distinct_values, r.editions, r.ratio) for r in claims.conflicts(grouped).collect()] == [("e", 2000, 2, "2001,2002", 1.2)]
    series = spark.createDataFrame([("a", 1, 0), ("a", 2, 5), ("a", 3, 4)], "k string, y int, v int")
    assert [(r.absolute_change, r.percent_change) for r in claims.change(series, ["k"], "y", "v").orderBy("y").collect()] == [(None, None), (5, None), (-1, -20.0)]


def test_facets(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "b", None]), rng.choice(["x", "y"]), rng.choice(["1", "2"])) for _ in range(200)]
    df = spark.createDataFrame(rows, "p string, q string, r string")
    got = {(x.axis, x.value): x["items"] for x in facets.facet_counts(df, ["p", "q", "r"], {"p": ["a"], "q": ["x"]}).collect()}
    for n, axis in enumerate("pqr"):
        others = [(0, ["a"]), (1, ["x"])]
        for value in {r[n] for r in rows if r[n]}:
            assert got[axis, value] == sum(r[n] == value and all(r[k] in ok for k, ok in others if k != n) for r in rows)
    grid = facets.coverage_grid(df, "q", "p", ["a"]).collect()
    assert sum(r.total for r in grid) == 200 and all(r.a + r.other == r.total for r in grid)


def test_quality(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, -1), (3, -1)], "id int, v int")
    checks = [quality.Check("bad", "error", df.where("v < 0"), F.col("id"), gate=True), quality.Check("none", "info", df.where("false"), F.col("id"))]
    out = {r.check_name: (r.findings, r["sample"]) for r in quality.run(checks).collect()}
    assert out == {"bad": (2, "3,3"), "none": (0, "")} and quality.gate_failed(quality.run(checks)).first()[0]
    assert sorted(map(tuple, quality.violations(df, {"positive": F.col("v") > 0}, F.col("id")).collect())) == [("positive", "3"), ("positive", "3")]
    assert quality.orphans(df, df.where("id < 3"), ["id"]).count() == 2
    left, right = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int"), spark.createDataFrame([("a", 1), ("c", 3)], "k string, n int")
    assert sorted(map(tuple, quality.reconcile(left, right, "k").collect())) == [("b", 2, 0, -2), ("c", 0, 3, 3)]


def test_fuzzy_join_loses_no_pair(spark):
    rng = random.Random(9)
    parts = ["stad", "mark", "vale", "esk", "ora", "una", "brou", "klin"]
    names = [(k, "".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) + rng.choice(["", " of x", ", lower"])) for k in range(80)] + [(80, None), (81, "")]
    df = spark.createDataFrame(names, "id int, name string")
    got = {(r.id_left, r.id_right) for r in search.fuzzy_join(df, "id", "name", df, "id", "name", 0.4).collect()}

    def grams(t):
        return {f"  {w} "[i : i + 3] for w in "".join(c if c.isalnum() else " " for c in t.lower()).split() for i in range(len(w) + 1)}

    want = {(a, b) for a, x in names for b, y in names if x and y and len(grams(x) & grams(y)) / len(grams(x) | grams(y)) > 0.4}
    assert got == want


def test_search(spark):
    docs = spark.createDataFrame([(1, "The harbours of the ferry, harbour"), (2, "A ferry."), (3, None), (4, "")], "id int, t string")
    index = search.inverted_index(docs, "id", F.col("t"))
    assert [r.id for r in search.all_terms(index, "id", search.query_terms(spark, "ferry harbour")).collect()] == [1]
    assert search.all_terms(index, "id", []).count() == 0 and search.all_terms(index, "id", ["nothing"]).count() == 0


def test_load_refuses_and_routes(spark):
    fields = spark.createDataFrame([(1, "aa", "Area", "5 km", 2001), (2, "aa", "Area", "mostly", 2001), (3, "aa", "Groups", "A 50%, B 150%", 2001), (4, "aa", "Borders", "C 5 km; total 9 km", 2001), (5, "aa", "Place", "10 00 N, 20 00 E", 2001), (6, "aa", "Story", "x" * 250, 2001), (7, "aa", "Skip", "y" * 250, 2001), (8, "aa", "Area", "NA", 2001)], "field_value_id int, source_key string, field_name string, raw_text string, edition_year int")
    rules = spark.createDataFrame([("Area", "narrative", None, 0), ("Area", "observation", "geo.area", 1), ("Groups", "composition", "g", 2), ("Borders", "bilateral", "b", 3), ("Place", "coordinate", "p", 4), ("Skip", "ignore", None, 5)], "field_name string, target_kind string, metric string, position int")
    out = load.load(fields, rules)
    assert sorted((r.field_value_id, r.value, r.period_precision, r.missing_reason) for r in out.observations.collect())[0][0] == 1 and out.observations.count() == 2
    assert [(r.label, r.share_percent is None) for r in out.members.orderBy("ordinal").collect()] == [("A", False), ("B", True)]
    assert [r.label for r in out.partners.collect()] == ["C"] and out.points.first().latitude == 10.0 and [r.field_value_id for r in out.narratives.collect()] == [6]
    assert sorted((r.field_value_id, r.error_code) for r in out.rejected.collect()) == [(2, "no_number_found"), (3, "share_out_of_range")]
    with pytest.raises(ValueError):
        load.load(fields, rules.where("false"))
