import pytest
from oracle import compare, connect

from tessera.llm import queries as q

QUERIES, SQL = q.queries(), q.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, small_data, name):
    compare(connect(small_data), spark, QUERIES[name], SQL[name], small_data)


def test_columns_and_relations(spark, small_data):
    want = {"p2_found": [("field_value_id", "bigint")], "p6_found": [("item_id_kept", "bigint"), ("item_id_copy", "bigint")], "p7_ids": [("doc_id", "bigint"), ("ids", "array<int>")], "p9_found": [("doc_id", "bigint")]}
    frames = {name: QUERIES[name](spark, small_data) for name in want}
    for name, columns in want.items():
        assert frames[name].dtypes == columns
    docs = spark.read.parquet(f"{small_data}/documents.parquet")
    assert frames["p7_ids"].count() == docs.count()
    assert QUERIES["p7_roundtrip"](spark, small_data).where("not same").count() == 0
    assert QUERIES["p9_kept"](spark, small_data).count() + frames["p9_found"].count() == docs.count()
    marked = QUERIES["p2_clean"](spark, small_data)
    assert marked.count() == spark.read.parquet(f"{small_data}/raw_field.parquet").count()
    assert marked.where("clean_text rlike '</?(b|p|li|table|span|h2)\\\\b|\\\\\\\\textbf|\\\\[\\\\[|\\\\{\\\\{'").count() == 0


def test_mixture_reaches_shares(spark, small_data):
    report = [r for r in QUERIES["p8_shares"](spark, small_data).collect() if r.tokens]
    total = sum(r.target_share for r in report)
    for r in report:
        assert abs(r.reached_tokens - r.given_tokens) <= 700 and r.most_copies <= r.max_repeats
        assert r.given_tokens / sum(x.given_tokens for x in report) == pytest.approx(r.target_share / total)


def test_mixture_of_corpus_size(spark, small_data):
    """A scarce source binds at max_repeats; it doesn't scale the mixture down."""
    report = [r for r in QUERIES["p8_shares_corpus"](spark, small_data).collect() if r.tokens]
    assert sum(r.given_tokens for r in report) == pytest.approx(sum(r.tokens for r in report))
    scarce = min(report, key=lambda r: r.tokens * r.max_repeats / r.target_share)
    assert scarce.reached_tokens == scarce.tokens * scarce.max_repeats and scarce.most_copies == scarce.max_repeats
    picked = QUERIES["p8_mixture_corpus"](spark, small_data).selectExpr("sum(n_tokens * copies)").first()[0]
    assert picked == sum(r.reached_tokens for r in report) > QUERIES["p8_shares"](spark, small_data).agg({"reached_tokens": "sum"}).first()[0]


def test_weighted_mixture(spark, small_data):
    """Copies follow the weights, shares and limits hold, and the queries agree with each other."""
    report = {r.source: r for r in QUERIES["p8_shares_weighted"](spark, small_data).collect()}
    picked = QUERIES["p8_mixture_weighted"](spark, small_data).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{small_data}/documents.parquet").withColumn("w", q._quality_weight()).collect()}
    assert len({r.doc_id for r in picked}) == len(picked) and all(docs[r.doc_id].w > 0 for r in picked)
    for s, r in report.items():
        of = [x for x in picked if x.source == s]
        assert sum(x.n_tokens * x.copies for x in of) == r.reached_tokens and sum(x.copies for x in of) == r.copies and max([x.copies for x in of], default=0) == r.most_copies <= r.max_repeats
    free = [r for r in picked if report[r.source].most_copies < report[r.source].max_repeats]
    if free:
        heavy = [x.copies for x in free if docs[x.doc_id].w >= 2]
        light = [x.copies for x in free if docs[x.doc_id].w < 1]
        assert not light or not heavy or sum(heavy) / len(heavy) >= sum(light) / len(light)


def test_large_mixture_takes_every_copy(spark, small_data):
    """At a size beyond all limits each record of a listed source is taken max_repeats times: worked out from the sizes alone."""
    sizes = {}
    for r in QUERIES["p8_mixture"](spark, small_data).sparkSession.read.parquet(f"{small_data}/documents.parquet").select("doc_id", "source").collect():
        sizes[r.doc_id] = r.source
    tokens = {r.doc_id: len(r.ids) for r in QUERIES["p7_ids"](spark, small_data).collect()}
    rows = QUERIES["p8_shares_large"](spark, small_data).collect()
    assert len(rows) == 9
    for r in rows:
        of = [n for i, n in tokens.items() if sizes[i] == r.source and n]
        assert (r.records, r.tokens) == (len(of), sum(of))
        assert r.copies == len(of) * r.max_repeats and r.reached_tokens == sum(of) * r.max_repeats and r.most_copies == (r.max_repeats if of else 0)
