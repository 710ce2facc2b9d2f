import random

from tessera.llm import copies


def brute(rows):
    groups = {}
    for i, name, url, attrs in rows:
        entries = tuple(sorted(copies.canonical(e) for e in copies._ENTRIES.split(attrs))) if attrs else ()
        groups.setdefault((copies.canonical(name), copies.canonical(url), entries), []).append(i)
    return {(min(g), i) for g in groups.values() for i in g if i != min(g)}, {min(g): len(g) for g in groups.values()}


def test_canonical():
    assert copies.canonical("  “Généralités—courts”\u200b !") == copies.canonical("GÉNÉRALITÉS courts") != copies.canonical("Generalites courts")
    assert copies.canonical("e\u0301") == copies.canonical("é") and copies.canonical(None) == copies.canonical("") == ""
    assert copies.canonical_entries("kind=ngo; data = api") == copies.canonical_entries("DATA:Api | KIND: ngo") != copies.canonical_entries("kind=ngo; data=apis")
    assert copies.canonical_entries("format=csv, json; kind=ngo") == copies.canonical_entries("kind=ngo\nformat: csv, json")


def test_against_brute_force(spark):
    rng = random.Random(4)
    rows = []
    for i in range(900):
        k = 0 if i % 3 == 0 else rng.randint(1, 60)  # one record holds a third of all rows
        name = rng.choice([f"Généralités {k}", f"généralités  {k}!", f"GÉNÉRALITÉS\xa0{k}", f"Generalites {k}"])
        url = rng.choice([None, "", f"https://x.example/{k}", f"HTTPS://X.example/{k}/", f"http://x.example/{k}"])
        attrs = rng.choice([None, "kind=ngo; data=api", "data: API | kind: Ngo", "data=api"])
        rows.append((i, name, url, attrs))
    df = spark.createDataFrame(rows, "item_id long, name string, url string, attrs string").withColumnRenamed("attrs", "attrs")
    c = copies.Copies(df, "item_id", ["name", "url"], ["attrs"])
    pairs, sizes = brute(rows)
    assert {tuple(r) for r in c.members().collect()} == pairs
    assert {r.item_id_kept: r.copies for r in c.records().collect()} == sizes


def test_repeated_rows_nulls_and_empty(spark):
    schema = "item_id long, name string, url string, attrs string, canonical string, n string"
    rows = [(1, "a", None, None, "x", "y"), (2, "A ", "", "", "x", "y"), (None, "a.", None, None, "x", "y"), (3, None, None, None, "x", "y"), (4, "", None, None, "x", "y"), (5, "x" * 100_000, "u", "k=v", "x", "y"), (6, "X" * 100_000, "U", "K: V", "x", "y")]
    df = spark.createDataFrame(rows, schema)
    c = copies.Copies(df, "item_id", ["name", "url"], ["attrs"])
    assert {tuple(r) for r in c.members().collect()} == {(1, 2), (3, 4), (5, 6)}
    assert {r.item_id_kept: r.copies for r in c.records().collect()} == {1: 3, 3: 2, 5: 2}
    e = copies.Copies(df.where("false"), "item_id", ["name", "url"], ["attrs"])
    assert e.members().count() == e.records().count() == 0
