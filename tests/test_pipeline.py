import hashlib
import json

import pytest

from tessera import pipeline
from tessera.operators import constraints, mart, quality

TEXT = b"@Aland:Geography\nArea: 5 sq km (1999 est.)\nBorders: Beland 5 km; Celand 7 km\nLanguages: A 50%, B 40%\n"


def build(tmp_path, tamper=False):
    raw = tmp_path / "raw"
    artifacts = []
    for k, (family, name, data) in enumerate([("text_era", "a.txt", TEXT), ("json_cache", "b.json", json.dumps({"name": "Beland", "code": "be", "categories": [{"title": "Geography", "fields": [{"name": "Area", "content": "7 sq km"}]}]}).encode()), ("text_era", "c.txt", b"@X:Geography\nArea: 1")]):
        digest = hashlib.sha256(data).hexdigest()
        artifacts.append({"artifact_id": f"a{k}", "filename": name, "size_bytes": len(data), "sha256": digest, "parser_family": family, "retrievals": [{"url": "https://x.example/a", "byte_stable": True}]})
        if k < 2 or tamper:
            (raw / digest).mkdir(parents=True)
            (raw / digest / name).write_bytes(data + b"tampered" * (k == 2))
    (tmp_path / "m.json").write_text(json.dumps({"schema_version": 1, "dataset": {"code": "d"}, "editions": [{"edition_year": 2000, "artifacts": artifacts}]}))
    return str(raw), str(tmp_path / "m.json")


def test_end_to_end(spark, tmp_path):
    raw, m = build(tmp_path)
    registry = pipeline.register(spark, m, str(tmp_path / "registry"))
    assert pipeline.register(spark, m, str(tmp_path / "registry")).count() == registry.count() == 3
    bronze, bad = str(tmp_path / "bronze"), str(tmp_path / "bad")
    for _ in range(2):
        pipeline.stage(spark, registry, raw, bronze, bad)
    assert spark.read.parquet(bronze).count() == 4
    assert [(r.artifact_id, r.error_code) for r in spark.read.parquet(bad).collect()] == [("a2", "artifact_not_stored")]
    rules = spark.createDataFrame([("Area", "observation", "geo.area", 0), ("Borders", "bilateral", "b", 1), ("Languages", "composition", "l", 2)], "field_name string, target_kind string, metric string, position int")
    assert pipeline.load(spark, bronze, rules, str(tmp_path / "silver")) == {"observation": 2, "composition": 2, "bilateral": 2, "point": 0, "narrative": 0, "rejected": 0}
    reported = spark.createDataFrame([("a0", 3), ("a1", 9)], "artifact_id string, n long")
    assert [tuple(r) for r in pipeline.reconcile(spark, bronze, reported).collect()] == [("a1", 9, 1, -8)]
    assert "| a1 |" in pipeline.report(pipeline.reconcile(spark, bronze, reported))


def test_tampered_bytes_are_quarantined(spark, tmp_path):
    raw, m = build(tmp_path, tamper=True)
    pipeline.stage(spark, pipeline.register(spark, m, str(tmp_path / "r")), raw, str(tmp_path / "b"), str(tmp_path / "q"))
    assert [r.error_code for r in spark.read.parquet(str(tmp_path / "q")).collect()] == ["digest_mismatch"]


def test_manifest_with_faults_is_refused(spark, tmp_path):
    (tmp_path / "m.json").write_text(json.dumps({"schema_version": 2, "dataset": {"code": "d"}, "editions": [{"edition_year": 2000, "artifacts": [{"artifact_id": "a", "sha256": "x", "size_bytes": 1, "retrievals": []}]}]}))
    with pytest.raises(ValueError, match="unsupported_schema_version"):
        pipeline.register(spark, str(tmp_path / "m.json"), str(tmp_path / "r"))


COLUMNS = "claim_id int, metric_id int, value_kind string, period_start date, period_end date, period_precision string, price_basis string, currency string, parse_status string, missing_reason string, field_value_id int, value_int bigint, value_num double, value_bool boolean, value_cat string, value_text string"


@pytest.mark.parametrize("change, rule", [
    ({}, None), ({"period_precision": None}, "period_precision_set"), ({"period_end": "1999-01-01"}, "period_not_empty"), ({"price_basis": None}, "price_basis_set"), ({"currency": "USD", "price_basis": "none"}, "currency_needs_basis"),
    ({"missing_reason": "unknown"}, "missing_iff_unparsed"), ({"field_value_id": None}, "has_provenance"), ({"value_text": "x"}, "exactly_one_value"), ({"value_int": None}, "exactly_one_value"), ({"value_int": None, "value_text": "x"}, "value_of_its_kind"), ({"metric_id": 7}, "metric_exists"), ({"metric_id": 2}, "kind_of_metric"),
])
def test_claim_rules(spark, change, rule):
    row = {"claim_id": 1, "metric_id": 1, "value_kind": "integer", "period_start": "2000-01-01", "period_end": "2001-01-01", "period_precision": "year", "price_basis": "nominal", "currency": None, "parse_status": "parsed_exact", "missing_reason": None, "field_value_id": 1, "value_int": 5, "value_num": None, "value_bool": None, "value_cat": None, "value_text": None} | change
    names = [c.split()[0] for c in COLUMNS.split(", ")]
    df = spark.createDataFrame([tuple(row[n] for n in names)], COLUMNS.replace("date", "string")).selectExpr(*(f"cast({n} as date) {n}" if n.startswith("period_") and n != "period_precision" else n for n in names))
    metrics = spark.createDataFrame([(1, "integer"), (2, "text")], "metric_id int, value_kind string")
    assert [r.rule for r in constraints.check_claims(df, metrics).collect()] == ([rule] if rule else [])


def test_other_rules(spark):
    names = spark.createDataFrame([(1, "A", True, "2000-01-01", None), (1, "B", True, "2001-01-01", None), (2, "C", True, None, "2000-01-01"), (2, "D", True, "2000-01-01", None)], "entity_id int, name string, is_preferred boolean, a string, b string").selectExpr("entity_id", "name", "is_preferred", "cast(a as date) valid_from", "cast(b as date) valid_to")
    ids = spark.createDataFrame([(1, "s", "x", None, "2000-01-01", None), (2, "s", "x", None, "2005-01-01", None), (3, "s", "x", "erroneous", "2005-01-01", None)], "entity_id int, scheme string, code string, status string, a string, b string").selectExpr("entity_id", "scheme", "code", "status", "cast(a as date) valid_from", "cast(b as date) valid_to")
    assert sorted(map(tuple, constraints.check_registry(names, ids).collect())) == [("one_entity_per_code", "s:x"), ("one_preferred_name", "1")]
    edges = spark.createDataFrame([(1, 1, 1, None), (2, 1, None, " "), (3, 1, None, "x"), (4, 1, 2, None)], "edge_id int, subject_id int, object_id int, object_label string")
    assert sorted(map(tuple, constraints.check_bilaterals(edges).collect())) == [("not_reflexive", "1"), ("object_identified", "2")]
    members = spark.createDataFrame([(1, 0, 50.0, None), (1, 0, 120.0, None), (2, 0, None, None)], "composition_id int, ordinal int, share_percent double, amount double")
    assert sorted(map(tuple, constraints.check_compositions(members).collect())) == [("ordinal_unique", "1"), ("quantity_present", "2"), ("share_in_range", "1")]


def test_texts_are_loaded_whole(spark):
    from tessera.operators.load import load

    story, bad = "Tea is sold. " * 1000, "no number here " * 500
    fields = spark.createDataFrame([(1, "aa", "Background", story, 2000), (2, "aa", "Area", bad, 2000)], "field_value_id long, source_key string, field_name string, raw_text string, edition_year int")
    rules = spark.createDataFrame([("Area", "observation", "area", 0)], "field_name string, target_kind string, metric string, position int")
    whole, short = load(fields, rules), load(fields, rules, cut=True)
    assert whole.narratives.first().text == story and len(short.narratives.first().text) == 4000
    assert whole.rejected.first().raw_input == bad and len(short.rejected.first().raw_input) == 2000


def test_refresh_keeps_the_tables_of_a_failed_job(spark, tmp_path):
    folder = str(tmp_path / "mart")
    assert mart.refresh({"d": spark.range(3).toDF("k")}, folder) == {"d": 3}
    broken = spark.range(2).selectExpr("raise_error('no') as k")
    with pytest.raises(Exception):
        mart.refresh({"d": broken}, folder)
    assert mart.current(spark, folder, "d").count() == 3
    assert mart.refresh({"d": spark.range(5).toDF("k")}, folder) == {"d": 5} and mart.current(spark, folder, "d").count() == 5
    stats = {r.column: r for r in mart.analyse(spark.createDataFrame([(1, None), (4, "x")], "a int, b string")).collect()}
    assert (stats["a"].least, stats["a"].greatest, stats["b"].nulls, stats["b"].rows) == ("1", "4", 1, 2)


def test_checks_of_values_and_bytes(spark):
    bounds = spark.createDataFrame([("a", 0.0, 10.0), ("b", None, 5.0)], "kind string, low double, high double")
    rows = spark.createDataFrame([(1, "a", -1.0), (2, "a", 10.0), (3, "b", 6.0), (4, "c", 1e9), (5, "a", None)], "id int, kind string, value double")
    assert sorted(r.id for r in quality.outside_range(rows, bounds, "kind", "value").collect()) == [1, 3]
    claims = spark.createDataFrame([(1, 5.0, True, "USD", None), (2, 2001.0, False, None, None), (3, 2001.0, False, None, "km"), (4, 2001.5, False, None, None), (5, None, None, None, None), (6, 2025.0, None, None, None)], "id int, v double, p boolean, c string, u string")
    assert sorted(r.id for r in quality.contradicts_unit(claims, "v", "p", "c", "u").collect()) == [1, 2, 6]
    stored = spark.createDataFrame([("x", 5, "d1"), ("y", 6, "d2"), ("z", 7, "d3")], "key string, size_bytes long, sha256 string")
    declared = spark.createDataFrame([("x", 5, "d1"), ("y", 9, "d2"), ("z", 7, "other"), ("w", 1, "d4")], "key string, size_bytes long, sha256 string")
    assert {tuple(r) for r in quality.changed_bytes(stored, declared).collect()} == {("y", "size_differs"), ("w", "not_stored")}
    assert {tuple(r) for r in quality.changed_bytes(stored, declared, deep=True).collect()} == {("y", "size_differs"), ("w", "not_stored"), ("z", "digest_differs")}
    checks = [quality.Check("one", "error", rows.where("id < 3"), rows.id, gate=True), quality.Check("none", "info", rows.where("false"), rows.id)]
    assert [tuple(r) for r in quality.run(checks, 1).orderBy("check_name").collect()] == [("none", "info", False, 0, ""), ("one", "error", True, 2, "1")]
    assert {tuple(r) for r in quality.undeclared(["one", "two"], checks, spark).collect()} == {("two", "declared_only"), ("none", "implemented_only")}
    assert tuple(quality.coverage(rows, rows.value.isNotNull()).first()) == ("parser_coverage", "info", 4, 5, 0.8) and quality.coverage(rows.where("false"), rows.id > 0).first().share == 0
