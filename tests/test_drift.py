from tessera.operators import drift


def build(spark):
    files = spark.createDataFrame([(1, "d", 2000, "text"), (2, "d", 2001, "text"), (3, "d", 2003, "text"), (4, "d", 2003, "delimited_export"), (5, "e", 2000, "text")], "artifact_id long, dataset_code string, edition_year int, parser_family string")
    rows = []

    def put(artifact, key, field, text, section="S", sub=""):
        rows.append((artifact, key, section, field, sub, text))

    for n, key in enumerate(["aa", "bb", "cc"]):
        for artifact in (1, 2, 3):
            put(artifact, key, "Area", f"{100 + n}")
        put(1, key, "Old", f"{n}.5 [b]")
        put(2, key, "New", f"{n}.5 [b]")
        put(3, key, "New", f"{n}.5 [b]")
        put(1, key, "Gone", f"text {n}")
        put(3, key, "Fresh", "n/a" if n else "12 May 1999", sub=None)
        put(1, key, "Kind", "7")
        put(2, key, "Kind", "7.5")
        put(3, key, "Kind", "8 %")
        put(4, key, "Never", "1")
        put(5, key, "Alone", "1")
    put(1, "aa", "Area", "100")  # staged twice
    put(1, None, None, None)
    put(2, None, None, None)
    put(3, None, None, None)
    return spark.createDataFrame(rows, "artifact_id long, source_key string, section_name string, field_name string, subfield_name string, raw_text string"), files


def test_changes(spark):
    d = drift.Drift(drift.staged_values(*build(spark)))
    got = sorted((r.dataset_code, r.edition_year, r.change_kind, r.old_path, r.new_path) for r in d.changes().collect())
    assert got == sorted([
        ("d", 2001, "renamed", "S|Old|", "S|New|"), ("d", 2001, "removed", "S|Gone|", ""), ("d", 2003, "added", "", "S|Fresh|"),
        ("d", 2001, "type_changed", "S|Kind|", "S|Kind|"), ("d", 2003, "type_changed", "S|Kind|", "S|Kind|"),
    ])


def test_consistent_table(spark):
    d = drift.Drift(drift.staged_values(*build(spark)))
    rows = d.consistent().where("path = 'S|New|'").collect()
    assert len(rows) == 9 and {r.source_path for r in rows} == {"S|Old|", "S|New|"} and {float(r.value_number) for r in rows} == {0.5, 1.5, 2.5}
    fresh = d.consistent().where("path = 'S|Fresh|'").collect()
    assert [(r.value_type, str(r.value_date)) for r in fresh] == [("date", "1999-05-12")]
    assert {r.value_type for r in d.consistent().where("path = 'S|Kind|'").collect()} == {"text"}


def test_chain_of_renames(spark):
    files = spark.createDataFrame([(k, "d", 2000 + k, "text") for k in range(6)], "artifact_id long, dataset_code string, edition_year int, parser_family string")
    rows = [(k, f"k{n}", "S", f"Name{k}", None, f"{n}") for k in range(6) for n in range(3)]
    d = drift.Drift(drift.staged_values(spark.createDataFrame(rows, "artifact_id long, source_key string, section_name string, field_name string, subfield_name string, raw_text string"), files))
    assert {r.canonical_path for r in d.aliases().collect()} == {"S|Name5|"}


def test_empty(spark):
    values, files = build(spark)
    d = drift.Drift(drift.staged_values(values.where("false"), files))
    assert d.changes().count() == 0 and d.aliases().count() == 0 and d.consistent().count() == 0


def test_classes(spark):
    from pyspark.sql import functions as F

    cases = {"12": "whole", "1,234": "whole", "-5": "whole", "1.5": "decimal", "12 %": "percentage", "-1.94%": "percentage", "1941-04-14": "date", "20 June 1941": "date", "Aug 13, 1931": "date", "May 1931": "text", "House of X": "text", "58,946 (revised)": "whole", "9.303 % (est.)": "percentage"}
    df = spark.createDataFrame([(k, v) for k, v in cases.items()], "t string, want string").select("t", "want", drift.kind_of(drift.bare(F.col("t"))).alias("got"))
    assert df.where("want <> got").collect() == []


def test_consistent_table_is_whole(spark):
    """Absences and equal texts at several ordinals are rows; every form of a date is read."""
    files = spark.createDataFrame([(1, "d", 2000, "text")], "artifact_id long, dataset_code string, edition_year int, parser_family string")
    dates = ["2020-03-05", "5 March 2020", "5. Mar. 2020", "March 5 2020", "Mar 5, 2020", "MARCH 5, 2020", "5.3.2020", "3/5/2020", "05.03.2020"]
    rows = [(1, 10, "aa", "S", "Day", None, k, x) for k, x in enumerate([*dates, "13/5/2020", "5 Sept 2020"])] + [(1, 10, "aa", "S", "Same", None, k, "7") for k in (0, 1, 1)] + [(1, 10, "aa", "S", "Same", None, 2, "n/a")]
    values = drift.staged_values(spark.createDataFrame(rows, "artifact_id long, record_id long, source_key string, section_name string, field_name string, subfield_name string, ordinal int, raw_text string"), files)
    got = drift.Drift(values).consistent(absences=True).collect()
    days = {r.ordinal: str(r.value_date) for r in got if r.path == "S|Day|"}
    assert [days[k] for k in range(11)] == ["2020-03-05"] * 9 + ["2020-05-13", "2020-09-05"]
    assert sorted((r.record_id, r.ordinal, r.value_text) for r in got if r.path == "S|Same|" and r.ordinal < 2) == [(10, 0, "7"), (10, 1, "7")]
    assert [(r.value_text, r.value_number) for r in got if r.path == "S|Same|" and r.ordinal == 2] == [(None, None)]
