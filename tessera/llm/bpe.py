"""Encoding of a corpus with a public byte-level BPE vocabulary.

Exact merges in linear time. An Aho-Corasick automaton over the vocabulary gives the longest token at each byte of a
piece. The encoder takes it, keeps it while the pair with the token before is compatible, that is, while the merges
would leave exactly these two tokens side by side, else tries the next shorter token, and steps back when none is
left; positions that led nowhere are marked, so no position is left twice. Compatibility of a pair is worked out once
by undoing merges along its seam and then read from a table. Decoding reads token bytes from one blob by offsets.

Defined results: null and empty texts have no ids (an empty list), and decode to an empty text. Strings that look
like special tokens are ordinary text. Texts are encoded whole.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterable, Sequence
from functools import lru_cache

import ahocorasick
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Vocabulary files of public_tokenizers by short name.
FILES = {"byte_bpe_50k": "byte_bpe_50k.tiktoken", "byte_bpe_multi_50k": "byte_bpe_multi_50k.tiktoken"}
#: Pieces remembered by each worker; a full table is emptied.
REMEMBERED = 300_000


class Encoder:
    """A vocabulary of byte strings whose ids are their merge ranks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.split = regex.compile(pattern).findall
        size = max(ranks.values()) + 1
        self.offsets = array("Q", bytes(8 * (size + 1)))
        pieces: list[bytes] = [b""] * size
        for token, rank in ranks.items():
            pieces[rank] = token
        self.blob = b"".join(pieces)
        for rank, token in enumerate(pieces):
            self.offsets[rank + 1] = self.offsets[rank] + len(token)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for token, rank in ranks.items():
            self.automaton.add_word(token.decode("latin-1"), rank)
        self.automaton.make_automaton()
        self.parts: dict[int, tuple[int, int]] = {}
        self.compatible: dict[tuple[int, int], bool] = {}
        self.seen: dict[str, tuple[int, ...]] = {}

    def token(self, rank: int) -> bytes:
        return self.blob[self.offsets[rank] : self.offsets[rank + 1]]

    def halves(self, rank: int) -> tuple[int, int]:
        """The two tokens the last merge of `rank` joined; a single byte is its own halves."""
        found = self.parts.get(rank)
        if found is None:
            symbols = [self.ranks[bytes([b])] for b in self.token(rank)]
            while len(symbols) > 2:
                joined = [(self.ranks.get(self.token(a) + self.token(b), rank), i) for i, (a, b) in enumerate(zip(symbols, symbols[1:]))]
                best, i = min(joined)
                if best >= rank:
                    raise ValueError(f"token {rank} can't be reached by merges")
                symbols[i : i + 2] = [best]
            found = self.parts[rank] = (symbols[0], symbols[-1])
        return found

    def fits(self, left: int, right: int) -> bool:
        """Whether merges leave `left` and `right` side by side."""
        pair = (left, right)
        known = self.compatible.get(pair)
        if known is not None:
            return known
        # Undo the later of the two merges again and again; a merge across the seam that would have come before it forbids the pair.
        bound = 1 << 62
        result = True
        while True:
            across = self.ranks.get(self.token(left) + self.token(right))
            if across is not None and across < bound:
                result = False
                break
            left_whole, right_whole = len(self.token(left)) == 1, len(self.token(right)) == 1
            if left_whole and right_whole:
                break
            if right_whole or (not left_whole and left > right):
                bound, left = left, self.halves(left)[1]
            else:
                bound, right = right + 1, self.halves(right)[0]
        self.compatible[pair] = result
        return result

    def encode_piece(self, piece: bytes) -> tuple[int, ...]:
        """Ids of one piece."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return (whole,)
        size = len(piece)
        at: list[list[int]] = [[] for _ in range(size)]  # tokens that begin at a byte, short to long
        for end, rank in self.automaton.iter(piece.decode("latin-1")):
            at[end + 1 - (self.offsets[rank + 1] - self.offsets[rank])].append(rank)
        for tokens in at:
            tokens.sort(key=lambda r: self.offsets[r + 1] - self.offsets[r])
        dead = bytearray(size + 1)
        path: list[int] = []
        choice: list[int] = []
        position, k = 0, len(at[0]) - 1
        while position < size:
            while k >= 0:
                rank = at[position][k]
                end = position + self.offsets[rank + 1] - self.offsets[rank]
                if not dead[end] and (not path or self.fits(path[-1], rank)):
                    break
                k -= 1
            if k >= 0:
                path.append(rank)
                choice.append(k)
                position = end
                if position < size:
                    k = len(at[position]) - 1
            else:
                dead[position] = 1
                rank = path.pop()
                position -= self.offsets[rank + 1] - self.offsets[rank]
                k = choice.pop() - 1
        return tuple(path)

    def encode(self, text: str | None) -> list[int]:
        ids: list[int] = []
        if text:
            seen = self.seen
            for piece in self.split(text):
                found = seen.get(piece)
                if found is None:
                    found = self.encode_piece(piece.encode("utf-8"))
                    if len(piece) <= 64:
                        if len(seen) >= REMEMBERED:
                            seen.clear()
                        seen[piece] = found
                ids.extend(found)
        return ids

    def count(self, text: str | None) -> int:
        return len(self.encode(text))

    def decode(self, ids: Iterable[int] | None) -> str:
        return b"".join(self.token(i) for i in ids).decode("utf-8", errors="replace") if ids is not None else ""


@lru_cache(maxsize=4)
def encoder(path: str, pattern: str) -> Encoder:
    """The encoder of a vocabulary file (one "base64 rank" per line), one per Python worker."""
    with open(path, "rb") as lines:
        return Encoder({base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}, pattern)


def vocabulary(name_or_path: str = "byte_bpe_50k") -> tuple[str, str]:
    """(path, splitting pattern) of a vocabulary; a path with a slash stands for itself."""
    import public_tokenizers

    path = name_or_path if "/" in name_or_path else public_tokenizers.path(FILES.get(name_or_path, name_or_path))
    return str(path), public_tokenizers.PATTERN


def ids_column(text: Column, name_or_path: str = "byte_bpe_50k") -> Column:
    """Token ids of a text column."""
    path, pattern = vocabulary(name_or_path)

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def ids(texts: pd.Series) -> pd.Series:
        encode = encoder(path, pattern).encode
        return pd.Series([encode(t) if isinstance(t, str) else [] for t in texts], dtype=object)

    return ids(text)


def count_column(text: Column, name_or_path: str = "byte_bpe_50k") -> Column:
    """Number of tokens of a text column."""
    path, pattern = vocabulary(name_or_path)

    @F.pandas_udf(T.LongType())
    def count(texts: pd.Series) -> pd.Series:
        count = encoder(path, pattern).count
        return pd.Series([count(t) if isinstance(t, str) else 0 for t in texts], dtype="int64")

    return count(text)


def decode_column(ids: Column, name_or_path: str = "byte_bpe_50k") -> Column:
    """Texts of a column of token ids."""
    path, pattern = vocabulary(name_or_path)

    @F.pandas_udf(T.StringType())
    def text(lists: pd.Series) -> pd.Series:
        decode = encoder(path, pattern).decode
        return pd.Series([decode(x) for x in lists], dtype=object)

    return text(ids)


def encode_corpus(documents: DataFrame, keep: Sequence[str], text: str = "text", name_or_path: str = "byte_bpe_50k") -> DataFrame:
    """The kept columns and ids of every row. Column names that clash with `ids` are the caller's to rename."""
    return documents.select(*keep, ids_column(F.col(text), name_or_path).alias("ids"))
