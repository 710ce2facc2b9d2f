import math

import pytest

from tessera.operators import units as u

UNITS = {
    "km2": ("area", 1.0), "ha": ("area", 0.01), "acre": ("area", 0.0040468564224), "m2": ("area", 1e-6), "mi2": ("area", 2.589988110336), "km": ("length", 1.0), "m": ("length", 0.001), "mi": ("length", 1.609344), "nmi": ("length", 1.852), "ft": ("length", 0.0003048),
    "kwh": ("energy", 1.0), "mwh": ("energy", 1e3), "twh": ("energy", 1e9), "gj": ("energy", 277.77777777777777), "t": ("mass", 1.0), "kg": ("mass", 0.001), "lb": ("mass", 0.00045359237), "kt": ("mass", 1000.0), "m3": ("volume", 1.0), "km3": ("volume", 1e9),
    "usd": ("money", 1.0), "gbp": ("money", 1.372), "jpy": ("money", 0.00812), "person": ("count", 1.0), "per_1000": ("rate", 1.0), "percent": ("rate", 10.0), "per_100000": ("rate", 0.01),
}
KNOWN = tuple(sorted((k, v[0]) for k, v in UNITS.items()))
FACTORS = {k: v[1] for k, v in UNITS.items()}
BASE = {"area": "km2", "length": "km", "energy": "kwh", "mass": "t", "volume": "m3", "money": "usd", "count": "person", "rate": "per_1000"}


def read(raw, kind, hint=None, scale=None, currency=None):
    return u.read_amount(raw, hint, scale, currency, kind, BASE.get(kind), FACTORS, KNOWN)


@pytest.mark.parametrize("raw, kind, hint, scale, currency, want", [
    ("30.419 billion m²", "area", None, None, None, 30419.0),
    ("an estimated 5.7792 births per 100,000 inhabitants", "rate", None, None, None, 0.057792),
    ("€ 2 bn", "money", None, None, None, None),
    ("¥4.6984 tn", "money", None, None, None, 4.6984e12 * 0.00812),
    ("39 851", "length", "m", "thousand", None, 39851.0),
    ("0.7 thousand gigajoules", "energy", "gigajoules", "thousand", None, 700 * 277.77777777777777),
    ("2.97930e6", "area", "ac.", None, None, 2.9793e6 * 0.0040468564224),
    ("1.5 × 10^5", "count", None, None, None, 150000.0),
    ("9.357,14 ac.", "area", None, None, None, 9357.14 * 0.0040468564224),
    ("56.109.500 MWh", "energy", None, None, None, 56109500e3),
    ("800,59 km (2004)", "length", None, None, None, 800.59),
    ("1,234", "length", None, None, None, 1234.0), ("1.234", "length", None, None, None, 1.234),
    ("8'614'800 (est.)", "count", "inhabitants", None, None, 8614800.0),
    ("300 pounds", "mass", None, None, None, 300 * 0.00045359237), ("300 pounds", "money", None, None, None, 300 * 1.372),
    ("5 m", "length", None, None, None, 0.005), ("$5 m", "money", None, None, None, 5e6), ("-3 km", "length", None, None, None, -3.0),
    ("782.117bn pounds sterling", "money", None, None, None, 782.117e9 * 1.372), ("2 cu km", "volume", None, None, None, 2e9), ("68.513 kms", "length", None, None, None, 68.513),
    ("4.2", "money", None, "million", "JPY", 4.2e6 * 0.00812), ("5 megawatt-hours", "energy", None, None, None, 5000.0), ("7 square kilometers", "area", None, None, None, 7.0), ("3 %", "rate", None, None, None, 30.0),
])
def test_amounts(raw, kind, hint, scale, currency, want):
    got = read(raw, kind, hint, scale, currency).amount
    assert got is None if want is None else math.isclose(got, want, rel_tol=1e-12), got


@pytest.mark.parametrize("raw, kind, reason", [
    (None, "area", "absent"), ("", "area", "absent"), ("NA", "area", "absent"), ("negligible", "area", "absent"), ("l,600 km", "length", "no_number_found"), ("4O,2OO", "length", "explanatory_note_not_a_value"), ("mostly seasonal", "length", "no_number_found"),
    ("data are in 2010 units", "money", "explanatory_note_not_a_value"), ("5 km", "mass", "other_dimension"), ("5 to 6 km", "length", "several_numbers"), ("12", None, "unknown_metric"), ("1,23,4", "length", "number_unparseable"),
])
def test_refusals(raw, kind, reason):
    assert read(raw, kind).reason == reason and read(raw, kind).amount is None


def test_long_text():
    assert read("about " * 2000 + "5 km", "length").amount == 5.0
    assert read("word " * 5000, "length").amount is None


@pytest.mark.parametrize("block", [7, 1000])
def test_equal_amounts_against_brute_force(spark, monkeypatch, block):
    import random

    monkeypatch.setattr(u, "BLOCK", block)
    rng = random.Random(5)
    rows = [(k, rng.choice("ab"), rng.choice([None, 0.0, rng.uniform(95, 105), rng.uniform(95, 105), -rng.uniform(95, 105), 1e-9, 1e15])) for k in range(300)]
    rows += [(k + 300, "hot", 7.0 if k % 2 else 7.01) for k in range(80)]
    found = u.EqualAmounts(spark.createDataFrame(rows, "id long, k string, v double"), ["k"], "id", "v")
    want = {(a[0], b[0]) for a in rows for b in rows if a[0] < b[0] and a[1] == b[1] and a[2] and b[2] and abs(a[2] - b[2]) < 0.005 * max(abs(a[2]), abs(b[2])) and a[2] * b[2] > 0}
    got = [tuple(r) for r in found.pairs().collect()]
    assert set(got) == want and len(got) == len(want)
    counted = {r.id: r for r in found.counted().collect()}
    assert set(counted) == {r[0] for r in rows if r[2]}
    assert all(r.links == sum(i in p for p in want) for i, r in counted.items())
    assert counted[300].copies == 40 and counted[300].class_id == 300 and counted[301].class_id == 301 and counted[300].links == 79
    none = u.EqualAmounts(spark.createDataFrame([], "id long, k string, v double"), ["k"], "id", "v")
    assert none.pairs().count() == none.counted().count() == 0


def test_normalise_nulls_and_clashes(spark):
    claims = spark.createDataFrame([(1, "5 km", None, None, None, "x", "keep"), (2, None, None, None, None, "x", "keep"), (3, "5", None, None, None, None, "keep"), (4, "5", None, None, None, "zz", "keep")], "parsed_value_id long, raw string, unit_hint string, scale_word string, currency string, metric_code string, base_amount string")
    metric = spark.createDataFrame([("x", "length", "km")], "metric_code string, quantity_kind string, base_unit string")
    ref = spark.createDataFrame([("km", "length", 1.0), (None, None, None)], "unit_code string, quantity_kind string, factor_to_base double")
    out = {r.parsed_value_id: (r.base_amount, r.amount_reason) for r in u.normalise(claims, metric, ref).collect()}
    assert out == {1: (5.0, None), 2: (None, "absent"), 3: (None, "unknown_metric"), 4: (None, "unknown_metric")}
    assert u.normalise(claims.where("false"), metric, ref).count() == 0
    with pytest.raises(ValueError):
        u.normalise(claims, metric, ref, most=1)
