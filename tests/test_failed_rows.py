import itertools
import random
import time

import pytest
from pyspark.sql import functions as F

from tessera.operators import failed_rows as fr

GOOD = ["ab", "2001", "Field", "3", 'some "text"; here', "1,234.5", "parsed_exact", "", "2001-02-03"]


SHORT = (fr.Field("letter", "[ab]"), fr.Field("any"), fr.Field("short", "|b|a,b"))


def line(cells, d):
    return d.join('"' + c.replace('"', '""') + '"' if d in c or '"' in c or "\n" in c else c for c in cells)


def brute(text, d):
    """Cells by a character machine written for the test, None where quoting is broken."""
    cells, cell, state = [], "", "start"
    for ch in text:
        if state == "start" and ch == '"':
            state = "quoted"
        elif state in ("start", "bare"):
            if ch == d:
                cells.append(cell.strip(" "))
                cell, state = "", "start"
            elif ch == '"':
                return None
            else:
                cell, state = cell + ch, "bare"
        elif state == "quoted":
            if ch == '"':
                state = "maybe"
            else:
                cell += ch
        elif ch == '"':
            cell, state = cell + '"', "quoted"
        elif ch == d:
            cells.append(cell)
            cell, state = "", "start"
        else:
            return None
    if state == "quoted":
        return None
    return [*cells, cell if state == "maybe" else cell.strip(" ")]


@pytest.mark.parametrize("d", [",", ";", "|", "\t"])
def test_strict_path_against_brute_force(d):
    rng = random.Random(7)
    for _ in range(3000):
        text = "".join(rng.choice(['"', d, "a", " ", "\n", "b"]) for _ in range(rng.randint(0, 12)))
        assert fr.strict_cells(text, d) == brute(text, d), repr(text)


def test_repair_is_cheapest_on_short_lines():
    """No set of fewer quote edits makes the line well quoted: all smaller sets are tried."""
    rng = random.Random(3)
    for _ in range(60):
        text = "".join(rng.choice(['"', ",", "a", "b"]) for _ in range(rng.randint(1, 6)))
        if brute(text, ",") is not None:
            continue
        _, edits, _, _ = fr.repair(text, ",", SHORT)
        quotes = [i for i, ch in enumerate(text) if ch == '"']
        for k in range(len(edits)):
            for ops in itertools.product(*[[("d", i) for i in quotes] + [("i", i) for i in range(len(text) + 1)]] * k):
                if len({o for o in ops if o[0] == "d"}) < sum(o[0] == "d" for o in ops):
                    continue
                gone = {i for o, i in ops if o == "d"}
                fixed = "".join('"' * sum(o == ("i", i) for o in ops) + ("" if i in gone or i == len(text) else text[i]) for i in range(len(text) + 1))
                assert brute(fixed, ",") is None, (text, edits, fixed)


def cheapest(text, layout):
    """(quote edits, delimiter edits, refused) of the cheapest parse: every parse is tried, none is merged with another."""
    n, m = len(text), len(layout)

    def end(i, mode, k, cell, cost, rest):
        cell = cell if mode == "closed" else cell.strip(" ")
        if k < m:
            yield from rest(k + 1, (cost[0], cost[1], cost[2] + (not layout[k].accepts(cell))))
        yield from rest(k, (cost[0], cost[1] + 1, cost[2]))

    def walk(i, mode, k, cell, cost):
        q, d, r = cost
        if mode == "start" and k < m and cell is not None:
            yield from walk(i, "start", k + 1, "", (q, d + 1, r))
        if mode == "start" and i < n:
            yield from walk(i, "quoted", k, "", (q + 1, d, r))
        if mode == "quoted":
            yield from walk(i, "closed", k, cell, (q + 1, d, r))
        if i == n:
            if mode != "quoted":
                yield from end(i, mode, k, cell, cost, lambda k2, c: iter([(c[0], c[1] + m - k2, c[2])]))
            return
        ch = text[i]
        if ch == '"':
            if mode in ("start", "bare"):
                yield from walk(i + 1, "bare", k, cell, (q + 1, d, r))
            if mode == "start":
                yield from walk(i + 1, "quoted", k, "", cost)
            if mode == "quoted":
                yield from walk(i + 1, "closed", k, cell, cost)
                yield from walk(i + 1, "quoted", k, cell, (q + 1, d, r))
                if text[i + 1 : i + 2] == '"':
                    yield from walk(i + 2, "quoted", k, cell + '"', cost)
        elif ch == ",":
            if mode == "quoted":
                yield from walk(i + 1, "quoted", k, cell + ch, cost)
            else:
                yield from end(i, mode, k, cell, cost, lambda k2, c: walk(i + 1, "start", k2, "", c))
        elif mode != "closed":
            yield from walk(i + 1, "bare" if mode == "start" else mode, k, cell + ch, cost)

    return min(walk(0, "start", 0, "", (0, 0, 0)))


def test_joint_minimum_against_brute_force():
    """Quotes, delimiters and refused values are minimised together."""
    rng = random.Random(11)
    broken = 0
    for _ in range(1500):
        text = "".join(rng.choice(['"', '"', ",", ",", "a", "b"]) for _ in range(rng.randint(1, 8)))
        _, quotes, moved, refused = fr.repair(text, ",", SHORT)
        assert (len(quotes), len(moved), len(refused)) == cheapest(text, SHORT), text
        cells = fr.strict_cells(text, ",")
        broken += cells is None
        if cells is not None:
            _, moved, refused = fr.align(cells, SHORT)
            assert (0, len(moved), len(refused)) == cheapest(text, SHORT), text
    assert broken > 500


@pytest.mark.parametrize("part, end", [('ab"c,', ""), ("abc,", '"'), ("abc,", ""), ('"', "a"), ('"a"",', "")])
def test_time_is_linear(part, end):
    def took(times):
        begun = time.perf_counter()
        fr.parse_line(part * times + end, ",", fr.EXPORT_LAYOUT)
        return time.perf_counter() - begun

    took(100)
    assert took(8_000) < 4 * 2 * max(took(2_000), 0.01)


@pytest.mark.parametrize("text, code", [
    (line(GOOD, ","), None),
    (line(GOOD, ",").replace("parsed_exact", "parsed exact"), "invalid_value"),
    (line(GOOD, ",").replace("2001-02-03", "2001-02-30"), "invalid_value"),
    (line(GOOD, ",").replace('"1,234.5"', '"12,34.5"'), "invalid_value"),
    (line(GOOD[:-1], ","), "wrong_column_count"),
    (line([*GOOD, ""], ","), "wrong_column_count"),
    ("", "wrong_column_count"), (None, "wrong_column_count"), ("   ", "wrong_column_count"),
    ('ab,2001,"Field" x,3,r,,unparsed,,2001-02-03', "broken_quoting"),
    ('ab,2001,"Field,3,r,,unparsed,,2001-02-03', "broken_quoting"),
    ('ab,2001, "Field",3,r,,unparsed,,2001-02-03', "broken_quoting"),
])
def test_codes(text, code):
    cells, found, edits, cost = fr.parse_line(text, ",", fr.EXPORT_LAYOUT)
    assert found == code and (cost > 0) == (code is not None) == bool(edits)


def test_long_line_and_null_delimiter():
    long = ["ab", "2001", "F", "3", "x" * 200_000, "", "unparsed", "", "2001-02-03"]
    assert fr.parse_line(",".join(long), None, fr.EXPORT_LAYOUT)[1] is None
    assert fr.parse_line(",".join(long) + '"', ",", fr.EXPORT_LAYOUT)[1] == "broken_quoting"


def test_split_with_clashing_and_missing(spark):
    schema = "raw_line_id long, artifact_id long, line_no int, line_text string, received_at timestamp, raw string"
    rows = [(1, 1, 1, "header", None, "x"), (2, 1, 2, line(GOOD, ";"), None, "x"), (3, 1, 3, None, None, None), (4, 9, 2, line(GOOD, ","), None, "x"), (5, None, 2, "", None, None), (5, None, 2, "", None, None)]
    lines = spark.createDataFrame(rows, schema)
    files = spark.createDataFrame([(1, ";", 2000)], "artifact_id long, delimiter string, edition_year int")
    good, bad = fr.export_outcome(lines.withColumn("delimiter", F.lit("#")).withColumn("edits", F.lit(1)), files)
    assert {r.raw_line_id: str(r.amount) for r in good.collect()} == {2: "1234.5000000000", 4: "1234.5000000000"}
    assert sorted((r.raw_line_id, r.failure_code) for r in bad.collect()) == [(3, "wrong_column_count"), (5, "wrong_column_count"), (5, "wrong_column_count")]
    none_good, none_bad = fr.export_outcome(lines.where("false"), files)
    assert none_good.count() == none_bad.count() == 0
    assert dict(good.dtypes)["published_on"] == "date" and good.select(F.max("value_failure_code") if "value_failure_code" in good.columns else F.max("failure_code")).count() == 1
