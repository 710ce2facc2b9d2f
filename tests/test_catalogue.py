import json

import pytest

from tessera.sources import catalogue


def test_scan_and_order(spark, tmp_path):
    (tmp_path / "AA.json").write_text(json.dumps([{"id": "1", "country": "AA", "topic": "t2", "name": "n", "url": "https://x.example", "verified": "2024-01-02", "surplus": 1}, {"id": "2", "country": "AA", "topic": "t1"}]))
    (tmp_path / "BB.json").write_text(json.dumps([{"id": "3", "country": "BB", "topic": "t2", "url": "https://y.example"}]))
    items = catalogue.read(spark, str(tmp_path / "*.json"))
    assert {r.id: r.file for r in items.collect()} == {"1": "AA.json", "2": "AA.json", "3": "BB.json"}
    topics = spark.createDataFrame([("t1", 0, 0), ("t2", 0, 1), ("t3", 1, 0)], "topic string, group_order int, topic_order int")
    places = spark.createDataFrame([("BB", 0), ("AA", 1)], "country string, place_order int")
    assert {r.id: r.place for r in catalogue.ordered(items, topics, places).collect()} == {"3": 1, "1": 2, "2": 1}
    edges = spark.createDataFrame([("t1", "t2"), ("t2", "t3")], "topic string, related string")
    kept, rest = catalogue.shaped(items, topics, edges)
    assert {r.topic: r.ordinal for r in kept.collect()} == {"t1": 0, "t2": 1} and [tuple(r) for r in rest.collect()] == [("t1", "t2")]
    assert catalogue.probe_targets(items, countries=["AA"]).count() == 1
    old = spark.createDataFrame([("1", "https://x.example")], "id string, url string")
    assert [r.id for r in catalogue.probe_targets(items, changed_since=old).collect()] == ["3"]
    with pytest.raises(ValueError):
        catalogue.probe_targets(items, ids=["9"])


def test_state():
    known = {"topic": {"t1"}, "access": {"open"}}
    state = catalogue.read_state("#topic=t1&access=secret&q=+a+&page=0&x=1", known)
    assert state == {"topic": "t1", "q": "a", "page": 1}
    assert catalogue.read_state(catalogue.write_state(state | {"page": 3}), known) == state | {"page": 3}
