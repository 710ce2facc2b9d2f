import random

import pyarrow as pa
import pytest

from tessera.llm import residue
from tessera.llm.residue import evidence, segments

CASES = {
    "placeholder": ["The {{ river }} floods.", "in {region} now", "${gdp} fell", "The %(year)s count", "near __RIVER__ in", "%CAPITAL% is", "[[GDP]] rose", "{% include 'year' %}", "<%= area_total %>", "@@year@@ x", "#{entry.title}", "[INSERT GDP HERE]", "[your text here]", "[À COMPLÉTER]", "<add figure> of", "<votre texte>", "the %s of", "fell #REF! in", "[object Object]", "rose XX.X percent", "to TODO: fill in", "is undefined of", "the NaN plants", "cifras None", "of &lt;name&gt; years", "[TBD]", "[Name of river]", "{{ " + "long " * 200 + "}}", "[insert " + "a note " * 100 + "]"],
    "filler": ["Lorem ipsum dolor sit.", "Adipiscing dolan aliqua magnat.", "xxxx xxxx xxxx xxxx", "foo bar foo bar foo bar foo bar foo bar", "blah blah blah blah blah", ".................... .................... ...................."],
    "error": ["It rose. Error 404", "Traceback: KeyError 'capital' in build_page", "Fehler 404", "Erreur 500 — Le serveur."],
}
PLAIN = [
    None, "", "  \n", "The court found no page of the treaty missing.", "Census years {1990, 2000} are printed in italics.", "The clerk's notice \"enable the script\" in the ledger refers to a change of alphabet in 1919.", "The count of 1961 left out 404 households not found at their listed address.",
    "A forbidden zone of 13 km surrounds the dam.", "Ballot papers follow a template on which the clerk writes the name of the district.", "Prices rose from $4 to $14 per sack.", "lists the figure as to be confirmed [see note 3].", "An error of 56.1 percent in the 1966 count was admitted.",
    "<|endoftext|> <|startoftext|>", "塔林谷地 塔林谷地 塔林谷地 塔林谷地", "a b c", "Most pupils test twice a year, and the test in Liamora is the harder one.", "LAS VENTAS SON SOBRE TODO MADERA.", "None of the farms grow tea.", "Die Wüste ist null und nichtig.", "Les 404 ménages introuvables à leur adresse furent exclus.",
]


@pytest.mark.parametrize("kind, text", [(k, t) for k, ts in CASES.items() for t in ts])
def test_cases(kind, text):
    assert kind in evidence(text)


@pytest.mark.parametrize("text", PLAIN)
def test_plain(text):
    assert evidence(text) == []


def test_whole_text():
    assert evidence("Tea is sold. " * 50_000 + "Lorem ipsum dolor sit amet.") == ["filler"]


def test_segments():
    text = 'Gone away — Ask again later.\r\nThe clerk wrote "Gone away. Ask again" in 1920. It cost 3.5 (three).  Code a1b2 Done'
    whole, begins, ends = (x.to_pylist()[0] for x in segments(pa.array([text])))
    assert whole.split("\n") == ["gone away", "ask again later", "the clerk wrote in", "it cost three", "code done"]
    assert begins.split("\n")[-1] == "code" and ends.split("\n")[-1] == "done"
    assert [x.to_pylist() for x in segments(pa.array(["", None, "..."]))][0] == ["", None, ""]


SCHEMA = "doc_id long, text string, title string, source_key string, section_name string, source string"
#: Responses in words the library can't know; the last three share no word with the others.
UNKNOWN = ["Nothing lives at this place.", "Ask the keeper, code q{k}z9.", "Hier wohnt niemand mehr.", "Zorp klee vantu mirra.", "Personne ne garde cette porte"]


def corpus():
    """(rows, ids with residue): ordinary texts of ten sentences, and each response at 24 addresses, two thirds of them as the whole body."""
    draw = random.Random(5)
    names = ["".join(draw.choice("bdfgklmnprst") + draw.choice("aeiou") for _ in range(4)).title() for _ in range(20_000)]
    patterns = ["The port of {} handled {} tons of wool.", "Farms near {} grow tea since {}.", "The count of {} found {} households.", "Rain in {} reached {} mm.", "The {} speak a language of {} dialects."]
    ordinary = lambda k, n=10: " ".join(draw.choice(patterns).format(draw.choice(names), 1000 + k) for _ in range(n))
    rows = [(k, ordinary(k), f"T{k % 90}", f"k{k % 7}", "Economy", f"h{k % 3}") for k in range(900)]
    rows += [(900 + k, ordinary(k, 1), f"T{k}", f"k{k % 7}", "Economy", f"h{k % 3}") for k in range(40)]
    found = set()
    for r, response in enumerate(UNKNOWN):
        for k in range(24):
            i = 2000 + 100 * r + k
            whole = response.format(k=k)
            rows.append((i, whole if k % 3 else f"{ordinary(k, 8)} {whole}", None if k % 5 == 0 else f"U{k}", f"k{k % 7}", None, f"h{k % 2}"))
            found.add(i)
    return rows, found


def test_responses_are_learned(spark):
    rows, found = corpus()
    ordinary = rows[0][1]
    rows += [
        (5000, "Nothing lives at this place Rain in Tabalaku reached 12 mm. " + ordinary, "T1", "k1", None, "h1"),  # runs into the next sentence
        (5001, ordinary + ' A visitor of 1920 read "Nothing lives at this place." on the gate.', "T2", "k1", None, "h1"),  # quoted
        (5002, "Ask the keeper of the lamp in Tabalaku.", "T3", "k1", None, "h1"), (5003, None, None, None, None, None), (5004, " \n", None, None, None, None),
        (5005, "{region} x", "T", "aa", "S", None), (5005, "{region} x", "T", "aa", "S", None),
    ]
    rows += [(6000 + k, f"A note that stands at one address only, {k}.", "Same", "k1", None, "h1") for k in range(30)]
    rows += [(7000 + k, f"The ferry of Ulmora is late, {k}.", "Ulmora: Ferry", f"k{k}", None, "h1") for k in range(30)]  # shares terms with its title
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(r.doc_id for r in residue.flagged(df).collect())
    assert got == sorted(found | {5000}) + [5005, 5005]
    kinds = {r.doc_id: r.kinds for r in residue.flagged(df).collect()}
    assert kinds[2000] == ["served_response"] and kinds[5005] == ["placeholder"]


def test_long_bodies_repeated_at_addresses(spark):
    """A body longer than all others is of low information if different addresses serve it."""
    rows, _ = corpus()
    long = " ".join(f"Word{k} by word{k} goes nowhere." for k in range(400))
    rows = [r for r in rows if r[0] < 2000] + [(8000 + k, long, f"L{k}", f"k{k}", None, "h1") for k in range(12)]
    assert {r.doc_id for r in residue.flagged(spark.createDataFrame(rows, SCHEMA)).collect()} == set(range(8000, 8012))


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert residue.flagged(df).count() == 0
    assert residue.flagged(df.drop("source")).count() == 0
