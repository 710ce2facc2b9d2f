import pytest

from tessera.llm import mixture


def test_allocation():
    targets = {"a": (0.5, 1), "b": (0.3, 2), "c": (0.2, 4), "none": (0.1, 2)}
    given = mixture.allocate({"a": 1000, "b": 1000, "c": 10}, targets, 1000)
    assert given["c"] == 40 and given["none"] == 0 and given["a"] / given["b"] == pytest.approx(5 / 3) and sum(given.values()) == pytest.approx(1000)
    exact = mixture.allocate({"a": 1000, "b": 1000, "c": 100}, targets, "exact")
    assert exact["c"] == pytest.approx(400) and exact["a"] == pytest.approx(1000)
    assert sum(mixture.allocate({}, targets).values()) == 0
    assert mixture.allocate({"a": 10, "b": 10}, {"a": (0.5, 1), "b": (0.5, 1)}, 1e9) == {"a": 10.0, "b": 10.0}


def sizes(spark, rows):
    return spark.createDataFrame(rows, "id long, source string, n_tokens long, weight double")


def test_shares_and_limits(spark):
    rows = [(k, "hot" if k % 3 else "mid", 5 + k % 40, 1.0) for k in range(3000)] + [(10_000 + k, "tiny", 20, 1.0) for k in range(5)] + [(20_000, None, 50, 1.0), (20_001, "other", 50, 1.0), (20_002, "mid", 0, 1.0)]
    targets = spark.createDataFrame([("hot", 0.5, 1), ("mid", 0.4, 3), ("tiny", 0.1, 4), ("absent", 0.1, 2), (None, 0.1, 1)], "source string, target_share double, max_repeats int")
    m = mixture.Mixture(sizes(spark, rows), targets, total=30_000)
    picked = m.chosen.collect()
    assert len({r.id for r in picked}) == len(picked)
    limit = {"hot": 1, "mid": 3, "tiny": 4}
    assert all(1 <= r.copies <= limit[r.source] for r in picked)
    report = {r.source: r for r in m.shares().collect()}
    assert report["tiny"].reached_tokens == 400 and report["absent"].reached_share == 0
    for s in ("hot", "mid"):
        assert abs(report[s].reached_tokens - report[s].given_tokens) <= 23
    assert sum(r.reached_share for r in report.values()) == pytest.approx(1)
    assert sorted(map(tuple, m.chosen.collect())) == sorted(map(tuple, mixture.Mixture(sizes(spark, rows), targets, total=30_000).chosen.collect()))


def test_pareto_prefers_weight(spark):
    """With unequal weights, inclusion follows the weights."""
    rows = [(k, "s", 10, 3.0 if k < 1000 else 1.0) for k in range(2000)]
    m = mixture.Mixture(sizes(spark, rows), spark.createDataFrame([("s", 1.0, 1)], "source string, target_share double, max_repeats int"), total=6000)
    heavy = m.chosen.where("id < 1000").count()
    light = m.chosen.where("id >= 1000").count()
    assert abs(heavy + light - 600) <= 1 and 2.3 < heavy / light < 3.9


def test_equals_sorting(spark):
    """The cut found by histograms is that of a full sort."""
    rows = [(k, "s", 1 + (k * 7919) % 97, 1.0) for k in range(1500)]
    m = mixture.Mixture(sizes(spark, rows), spark.createDataFrame([("s", 1.0, 5)], "source string, target_share double, max_repeats int"), total=20_000)
    ranked = sorted(((r.rank, r.id, r.n_tokens) for r in m.ranked.collect()))
    total, want = 0, set()
    for _, i, n in ranked:
        if total + n / 2 <= m.given["s"]:
            want.add(i)
        total += n
    assert {r.id for r in m.chosen.collect()} == want


def test_empty_and_repeated(spark):
    targets = spark.createDataFrame([("s", 1.0, None)], "source string, target_share double, max_repeats int")
    m = mixture.Mixture(sizes(spark, []), targets)
    assert m.chosen.count() == 0 and m.shares().collect()[0].reached_tokens == 0
    twice = mixture.Mixture(sizes(spark, [(1, "s", 5, 1.0), (1, "s", 5, 1.0), (None, "s", 5, 1.0)]), targets)
    assert twice.chosen.count() == 3


def test_expand(spark):
    docs = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "doc_id long, text string, copy string").drop("copy")
    chosen = spark.createDataFrame([(1, "s", 5, 3)], "id long, source string, n_tokens long, copies int")
    assert sorted((r.doc_id, r.copy) for r in mixture.expand(docs, chosen).collect()) == [(1, 1), (1, 2), (1, 3)]
