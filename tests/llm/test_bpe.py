import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import bpe

P = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def ours():
    return bpe.encoder(*bpe.vocabulary())


@pytest.fixture(scope="module")
def theirs():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


def test_equal_to_the_library(ours, theirs):
    rng = random.Random(2)
    alphabet = ["a", "b", "the", " ", "  ", "\n", "é", "ß", "塔", "👩‍👩‍👧", "'ll", "'s", "0", "19", ".", "<|endoftext|>", "‎", "́", "\x0b", "​"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(2000)]
    texts += ["a" * 3000, "ab" * 2000, " " * 3000, "\n" * 500, "abcabcabc" * 300, "塔" * 400, "<|startoftext|>"]
    for t in texts:
        ids = ours.encode(t)
        assert ids == theirs(t), t[:60]
        assert ours.decode(ids) == t


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80))
def test_round_trip(text):
    text = text.encode("utf-8", "ignore").decode()
    e = bpe.encoder(*bpe.vocabulary())
    assert e.decode(e.encode(text)) == text


def test_exact_merges_of_a_small_vocabulary():
    """Against merging by rank, on every string of a small alphabet."""
    import itertools

    ranks = {b"a": 0, b"b": 1, b"c": 2, b"ab": 3, b"bc": 4, b"aab": 5, b"abc": 6, b"bca": 7, b"aa": 8, b"cab": 9}

    def merge(piece):
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while True:
            best = min(((ranks.get(x + y, 99), i) for i, (x, y) in enumerate(zip(parts, parts[1:]))), default=(99, 0))
            if best[0] == 99:
                return tuple(ranks[p] for p in parts)
            parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]

    reachable = {k: v for k, v in ranks.items() if len(merge(k)) == 1}
    ranks = {k: v for k, v in enumerate(sorted(reachable, key=reachable.get))}
    ranks = {v: k for k, v in ranks.items()}
    e = bpe.Encoder(ranks, r"\w+")
    for n in range(1, 8):
        for letters in itertools.product(b"abc", repeat=n):
            assert e.encode_piece(bytes(letters)) == merge(bytes(letters)), bytes(letters)


def test_columns(spark):
    df = spark.createDataFrame([(1, "the harbour"), (2, None), (3, ""), (4, "<|endoftext|>"), (4, "<|endoftext|>")], "doc_id long, text string")
    out = sorted(map(tuple, bpe.encode_corpus(df, ["doc_id"]).collect()), key=str)
    assert [len(x[1]) > 0 for x in out] == [True, False, False, True, True] and all(50256 not in x[1] for x in out)
    assert bpe.encode_corpus(df.where("false"), ["doc_id"]).count() == 0
    from pyspark.sql import functions as F

    assert [r[0] for r in df.select(bpe.count_column(F.col("text"))).collect()][1:3] == [0, 0]
