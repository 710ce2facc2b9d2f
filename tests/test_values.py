from decimal import Decimal

from pyspark.sql import functions as F

from tessera.functions import temporal, text, urls, values as v

VALUES = {
    "$2.14 trillion (2023 est.)": (Decimal("2140000000000"), 2023, "parsed_with_qualifier", None, None),
    "12.3% (2024 est.)": (Decimal("12.3"), 2024, "parsed_with_qualifier", None, None),
    "less than 1%": (Decimal(1), None, "parsed_partial", None, None),
    "NA": (None, None, "unparsed", "not_reported", None), "NA%": (None, None, "unparsed", "not_reported", None), "$NA, NA% of GDP": (None, None, "unparsed", "not_reported", None),
    "negligible": (None, None, "unparsed", "negligible", None), "none": (None, None, "unparsed", "not_applicable", None), "none (2004)": (None, 2004, "unparsed", "not_applicable", None), "(2004 est.)": (None, 2004, "unparsed", "not_reported", None),
    "1,234 km": (Decimal(1234), None, "parsed_exact", None, None), "l,600": (None, None, "unparsed", None, "no_number_found"), "15-20% (1991 est.)": (Decimal(15), 1991, "parsed_partial", None, None), "-2.5% (2010 est.)": (Decimal("-2.5"), 2010, "parsed_with_qualifier", None, None),
    "$41.65 billion (2017 est.) $39.72 billion (2016 est.)": (Decimal("41650000000"), 2017, "parsed_partial", None, None), "data are in 2010 US dollars": (None, 2010, "unparsed", None, "explanatory_note_not_a_value"),
    "12.5 births/1,000 population": (Decimal("12.5"), None, "parsed_exact", None, None), "NA births/1,000 population": (None, None, "unparsed", "not_reported", None), "": (None, None, "unparsed", "not_reported", "empty"), None: (None, None, "unparsed", "not_reported", "empty"),
    "mostly flat": (None, None, "unparsed", None, "no_number_found"), "5,000 ((a (b)) c)": (Decimal(5000), None, "parsed_with_qualifier", None, None),
}


def test_parse_value(spark):
    df = spark.createDataFrame([(k, "x") for k in VALUES] + [("7", "x")] * 2, "raw string, parsed string")
    got = {r.raw: r.p for r in v.parse_value(df, "raw", "p").collect()}
    for raw, want in VALUES.items():
        p = got[raw]
        assert (p.value, p.reference_year, p.status, p.missing_reason, p.failure_code) == want, raw
    assert got["1,234 km"].unit_hint == "km" and got["$2.14 trillion (2023 est.)"].currency == "USD" and got["$2.14 trillion (2023 est.)"].is_estimate and got["less than 1%"].inequality == "less_than"
    assert v.parse_value(df.where("false"), "raw", "p").count() == 0
    assert v.parse_value(df, "raw", "p").columns == ["raw", "parsed", "p"]


def test_unparsed_iff_no_value(spark, small_data):
    """A value or a reason, never both and never neither, on every published value."""
    df = v.parse_value(spark.read.parquet(f"{small_data}/parsed_value.parquet").select("raw"), "raw", "p")
    assert df.where("(p.value is null) <> (p.missing_reason is not null or p.failure_code is not null)").count() == 0
    assert df.where("(p.status = 'unparsed') <> (p.value is null)").count() == 0


def test_format_and_parse_back(spark):
    rows = [(f"{sign}{n:,}.{f:02d}", Decimal(f"{sign}{n}.{f:02d}")) for sign in ("", "-") for n in (0, 7, 12, 999, 1000, 123456, 98765432) for f in (0, 5, 99)]
    df = v.parse_value(spark.createDataFrame(rows, "raw string, want decimal(38,10)"), "raw", "p")
    assert df.where("p.value is distinct from want").count() == 0


def test_shares_and_partners(spark):
    raw = ["Czech (official) 88.4%, Slovak 1.5%, other 2.6% (2011 census)", "Alpha 50%; Beta, Lower (a, b; c) 1,200 30%", "this entry includes only adults of the land", "NA", None, ""]
    df = spark.createDataFrame([(k, r) for k, r in enumerate(raw)], "id int, raw string")
    rows = {r.id: r for r in v.parse_shares(df, "raw").collect()}
    assert [(m.label, m.share_percent) for m in rows[0].members] == [("Czech", Decimal("88.4")), ("Slovak", Decimal("1.5")), ("other", Decimal("2.6"))]
    assert rows[0].header.reference_year == 2011 and rows[0].header.status == "parsed_exact"
    assert [m.label for m in rows[1].members] == ["Alpha", "Beta", "Lower 1,200"]
    assert rows[2].header.failure_code == "no_members_found" and rows[3].header.missing_reason == "not_reported" and rows[4].header.missing_reason == "not_reported"
    partners = spark.createDataFrame([(0, "Austria 402 km; Germany 1,704 km; 12 km; Far isle"), (1, "Germany 32%, France 8.5%"), (2, None), (3, "none")], "id int, raw string")
    out = {r.id: [(m.label, m.value, m.unit_hint, m.is_percent) for m in r.partners] for r in v.parse_partners(partners, "raw").collect()}
    assert out == {0: [("Austria", Decimal(402), "km", False), ("Germany", Decimal(1704), "km", False), ("Far isle", None, None, False)], 1: [("Germany", Decimal(32), None, True), ("France", Decimal("8.5"), None, True)], 2: [], 3: []}


def test_coordinates(spark):
    cases = {"49 45 N, 15 30 E": (49.75, 15.5, None), "15 30 E, 49 45 N": (49.75, 15.5, None), "33 00 S, 70 30 W": (-33.0, -70.5, None), "49.75 N, 15.5 E": (49.75, 15.5, None), "95 00 N, 15 00 E": (None, None, "out_of_range"), "10 00 N, 20 00 N": (None, None, "ambiguous_hemispheres"), "in the hills": (None, None, "no_coordinate_found"), "": (None, None, "empty"), None: (None, None, "empty")}
    df = spark.createDataFrame([(k,) for k in cases], "raw string")
    for r in v.parse_coordinate(df, "raw", "c").collect():
        assert (r.c.latitude, r.c.longitude, r.c.failure_code) == cases[r.raw], r.raw


def test_small_functions(spark):
    one = spark.range(1)
    value = lambda e: one.select(e.alias("x")).first().x
    assert value(v.normalise_space(F.lit(" a  b\n\tc "))) == "a b c"
    assert value(v.slugify(F.lit("Côte d'Ivoire (West)"))) == "cote-d-ivoire-west"
    assert value(v.category_code(F.lit("  Other  "))) == "other" and value(v.is_residual(F.lit("other")))
    assert value(v.qualified(F.lit("Area"), F.lit(" "))) == "Area" and value(v.qualified(F.lit("Area"), F.lit("total"))) == "Area / total"
    assert value(text.similarity(text.trigrams(F.lit("word")), text.trigrams(F.lit("two words")))) == 4 / 11
    assert value(text.terms(F.lit("The harbours were running studies"))) == ["harbour", "runn", "study"]
    assert value(urls.host(F.lit("HTTPS://me@www.X.Example:80/a"))) == "x.example" and value(urls.canonical(F.lit("http://x.example/a/?q=1#f"))) == "x.example/a"
    assert value(urls.scrub(F.lit("https://x.example/login/a?b"))) == "https://x.example" and value(urls.scrub(F.lit("https://x.example/a?b"))) == "https://x.example/a"
    assert value(urls.link_state(F.lit(404), F.lit(200), F.lit(None).cast("int"))) == "ok" and value(urls.link_state(F.lit(None).cast("int"), F.lit(None).cast("int"), F.lit(None).cast("int"))) == "unreachable"
    d = lambda s: F.lit(s).cast("date")
    assert value(temporal.overlaps(d("2000-01-01"), d(None), d("1990-01-01"), d("2000-01-02"))) and not value(temporal.overlaps(d("2000-01-01"), d("2001-01-01"), d("2001-01-01"), d(None)))


def test_overlap_violations_against_pairs(spark):
    import random

    rng = random.Random(1)
    rows = [(k, rng.choice("ab"), rng.choice([None, *[f"20{y:02d}-01-01" for y in range(8)]]), rng.choice([None, *[f"20{y:02d}-01-01" for y in range(8, 12)]])) for k in range(12)] + [(99, None, None, None)]
    df = spark.createDataFrame(rows, "id int, k string, a string, b string").selectExpr("id", "k", "cast(a as date) a", "cast(b as date) b")
    got = {r.id for r in temporal.overlap_violations(df, ["k"], "a", "b", ["id"]).collect()}
    key = lambda r: (r[2] or "0001-01-01", r[0])
    want = {x[0] for x in rows for y in rows if x[1] and x[1] == y[1] and key(y) < key(x) and (x[2] or "0001") < (y[3] or "9999") and (y[2] or "0001") < (x[3] or "9999")}
    assert got == want
