import random

import pytest

from tessera.operators import packed
from tessera.operators.packed import members


def labels(text):
    return [m.label for m in members(text)]


def test_shapes():
    assert labels('Malst 26 mi / "Thain / Duo" 61 mi') == ["Malst", "Thain / Duo"]
    assert labels('"Lulhir ""the Elder"", Sun" 30.1 percent; Jax 23.4 percent') == ['Lulhir "the Elder", Sun', "Jax"]
    assert labels("Jamost 36%, and Leanost 27.7%") == ["Jamost", "Leanost"]
    assert labels("Bin 50.0% | Duo 31.3% | | Tri 11% | ") == ["Bin", "Duo", "Tri"]
    assert labels("Kax 414 km • Las 7,645 km (est.; not, counted) • Rou 30") == ["Kax", "Las", "Rou"]
    assert labels("'Dirt; new' 108\tSkö 70\t«Nain» 87") == ["Dirt; new", "Skö", "Nain"]
    assert labels("Rust (28%); Sand: 4% (2011 est.)") == ["Rust", "Sand"]
    assert labels("O'Brien 5%; N'Djamena 6") == ["O'Brien", "N'Djamena"]
    assert labels("A 1 234 km; B 5 000") == ["A", "B"]


def test_nothing():
    for text in (None, "", "   ", "NA", "n/a", "none reported", "; ; ,", "-"):
        assert members(text) == []


def test_malformed_marks_backtrack():
    found = members('"a b" 5%, "c; d')
    assert [m.label for m in found] == ["a b", '"c', "d"] and found[1].flag == "unbalanced_quote"
    assert members("x (5, y 6")[0].flag == "unbalanced_bracket"


def test_long_text_is_read_whole():
    assert len(members("; ".join(f"Name {k}%" for k in range(50_000)))) == 50_000


def test_against_generated_lists():
    """Lists made from known labels come back, whatever the delimiter, quoting, amounts and notes."""
    rng = random.Random(11)
    names = ["Alpha", "North-East Beta", "Gámma", "Old Delta"]
    hard = ["Eps / Zeta", "Eta, Lower", "Theta; new rite", 'Old "Iota" Kappa']
    for _ in range(2000):
        delimiter = rng.choice(["; ", ", ", " | ", " / ", "\n", "\t", ";", " • "])
        want, parts = [], []
        for _ in range(rng.randint(1, 7)):
            label = rng.choice(names + hard)
            text = label
            if label in hard or rng.random() < 0.2:
                style = rng.choice(['"', "“", "«", "'"]) if '"' not in label else '"'
                text = {'"': '"%s"' % label.replace('"', '""'), "“": f"“{label}”", "«": f"«{label}»", "'": f"'{label}'"}[style]
            amount = rng.choice([" 5%", " 1,234 km", ": 7.5%", " (8%)", " 12 mi", " 1,000", ""])
            note = rng.choice(["", "", " (official)", " (in the east, some; others)"])
            want.append(label)
            parts.append(text + amount + note)
            if rng.random() < 0.1:
                parts.append("")
        assert labels(delimiter.join(parts)) == want, delimiter.join(parts)


def test_columns(spark):
    rows = [(1, "A 5%; B 6%", "Languages"), (2, None, "Languages"), (3, "A", "Religions"), (4, "", "Religions"), (1, "A 5%; B 6%", "Languages")]
    df = spark.createDataFrame(rows, "field_value_id long, raw_text string, list_position string")
    out = packed.explode_labels(df.drop("list_position"), ["field_value_id"], "raw_text", least=2)
    assert sorted(map(tuple, out.collect())) == [(1, 1, "A"), (1, 1, "A"), (1, 2, "B"), (1, 2, "B")]
    full = packed.explode_members(df.drop("list_position"), ["field_value_id"], "raw_text")
    assert full.count() == 5 and full.where("amount = '5%'").count() == 2
    assert packed.explode_labels(df.where("false").drop("list_position"), ["field_value_id"], "raw_text").count() == 0


def test_hostile_texts_take_linear_time():
    import time

    for part in ("(a ", "[a ", '"a ', "'a ", "«a ", "(“", "a and ", "1,234 "):
        begun = time.perf_counter()
        members(part * 30_000)
        assert time.perf_counter() - begun < 10, part


@pytest.mark.parametrize("blanks", [0, 3, 20, 5000])
def test_blanks_before_a_quote_change_nothing(blanks):
    assert labels(" " * blanks + '"Alpha, Beta"; Gamma') == ["Alpha, Beta", "Gamma"]
    assert labels("Alpha; and " + " " * blanks + '"Beta, Gamma"') == ["Alpha", "Beta, Gamma"]
    assert labels("an" + " " * (blanks + 1) + 'd "Alpha, Beta"') == labels('an d "Alpha, Beta"')
