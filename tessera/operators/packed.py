"""Several values packed in one field: a parsing expression grammar with ordered alternatives.

    list    <- sep* (member (sep+ member)*)? sep*
    member  <- and? label (':' / note / amount)*
    label   <- quoted / bare
    quoted  <- '"' ('""' / !'"' .)* '"' &edge  /  “…” / «…» / ‹…› / „…“ / '…' &edge
    note    <- '(' (note / !')' .)* ')'        /  '[' … ']'
    bare    <- (!sep !note !amount-at-end .)+
    sep     <- [;|•·\n\r\t/] (slashes between blanks only) / ',' !digits-group / ' and '

Alternatives are tried in order and the first that fits wins. A quote that never closes, or closes in the middle of
a word, makes the quoted alternative fail; the parser backtracks and reads the mark as an ordinary character, and
the member carries the flag ``unbalanced_quote``. A note that never closes likewise (``unbalanced_bracket``).

Defined results: null, empty and blank texts, statements of absence and texts of separators only have no members.
Positions count from 1 over the members that aren't empty. Texts of any length are read whole, in one pass.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Statements that a value is absent, lower case (fixed values).
ABSENCES = frozenset({"na", "n/a", "n.a.", "n.a", "negl", "negl.", "-", "--", "none", "none reported", "not available", "unknown"})

#: Opening and closing quotation marks (fixed values). A single quote also stands within words.
QUOTES = {'"': '"', "“": "”", "«": "»", "‹": "›", "„": "“", "‘": "’", "'": "'"}
BRACKETS = {"(": ")", "[": "]"}

_UNITS = r"%|‰|percent\b|per\s?cent\b|pct\b|sq\.?\s?(?:km|mi)\b|km2?\b|km²|mi²?\b|miles?\b|kilomet(?:er|re)s?\b|metres?\b|meters?\b|m\b|nm\b|nmi\b|ft\b|ha\b"
_SCALES = r"thousand\b|million\b|billion\b|trillion\b|bn\b|mn\b"
_NUMBER = r"[-–−+]?(?:\d{1,3}(?:[, '   ]\d{3})+|\d+)(?:\.\d+)?|\.\d+"
_AMOUNT = re.compile(rf"(?:^|\s+|(?=\())\(?\s*(?:[~<>≤≥±]|about|approximately|approx\.|ca\.)?\s*(?:[$€£¥]\s*)?(?:{_NUMBER})(?:\s*[-–]\s*(?:{_NUMBER}))?\s*(?:(?:{_SCALES})\s*)?(?:{_UNITS})?\s*\)?\s*$", re.I)
#: Runs that hold no character with a meaning.
_PLAIN = re.compile(r"(?:[^;|•·\n\r\t/,\"“«‹„‘'()\[\] ]| (?![ /]|and\s)|(?<=[^\W\d_])'(?=[^\W\d_]))+", re.I)
_AND = re.compile(r"\s+and\s+(?=\S)", re.I)
_GROUP = re.compile(r",\d{3}(?!\d)")


class Member(NamedTuple):
    position: int
    label: str
    note: str | None
    amount: str | None
    flag: str | None


def _quoted(text: str, at: int) -> tuple[str, int] | None:
    """The quoted alternative at `at`: (text within the marks, end), or None to backtrack."""
    opening = text[at]
    closing, k = QUOTES[opening], at + 1
    while True:
        q = text.find(closing, k)
        if q < 0:
            return None
        if opening == '"' and text.startswith('""', q):
            k = q + 2
            continue
        if opening in "'‘" and q + 1 < len(text) and (text[q + 1].isalnum()):
            k = q + 1  # an apostrophe within a word
            continue
        if q + 1 < len(text) and text[q + 1].isalnum():
            return None  # the mark closes in the middle of a word
        inner = text[at + 1 : q]
        return (inner.replace('""', '"') if opening == '"' else inner), q + 1


_BRACKET = re.compile(r"[()\[\]]")


def _brackets(text: str) -> dict[int, int]:
    """Where the bracket opened at each position ends; one that never closes isn't there. One pass for the whole text."""
    ends: dict[int, int] = {}
    opened: dict[str, list[int]] = {c: [] for c in BRACKETS.values()}
    for m in _BRACKET.finditer(text):
        c = m.group()
        if c in BRACKETS:
            opened[BRACKETS[c]].append(m.start())
        elif opened[c]:
            ends[opened[c].pop()] = m.end()
    return ends


def _separator(text: str, at: int) -> int | None:
    """End of a separator at `at`, or None."""
    c = text[at]
    if c in ";|•·\n\r\t":
        return at + 1
    if c == ",":
        if at and text[at - 1].isdigit() and _GROUP.match(text, at):
            return None  # groups thousands
        return None if at and text[at - 1].isdigit() and text[at + 1 : at + 2].isdigit() else at + 1
    if c == "/":
        before, after = text[at - 1 : at] if at else " ", text[at + 1 : at + 2] or " "
        return at + 1 if before.isspace() or after.isspace() else None
    if c == " " and (m := _AND.match(text, at)):
        return m.end()
    return None


def members(text: str | None, absences: Iterable[str] = ABSENCES) -> list[Member]:
    """The members of one packed text."""
    if not text or not (stripped := text.strip()) or stripped.lower() in absences:
        return []
    found: list[Member] = []
    at, end = 0, len(text)
    brackets = _brackets(text) if "(" in text or "[" in text else {}
    hopeless: set[str] = set()  # quotes that close nowhere in the rest of the text
    lead, gap = "", False  # what stands before a mark, while it could be nothing or "and", and whether blanks follow it
    bare: list[str] = []
    notes: list[str] = []
    quoted: str | None = None
    flag: str | None = None

    def finish() -> None:
        nonlocal bare, notes, quoted, flag, lead, gap
        rest = " ".join("".join(bare).split())  # the pattern of amounts never meets a run of blanks
        if rest.lower().startswith("and ") and (found or quoted is None):
            rest = rest[4:].lstrip()
        elif quoted is not None and rest.lower() == "and":
            rest = ""
        amount = None
        if m := _AMOUNT.search(rest):
            amount, rest = m.group().strip(" ()") or None, rest[: m.start()]
        rest = rest.strip().rstrip(":").strip() if quoted is None else rest
        label = quoted.strip() if quoted is not None else " ".join(rest.split())
        if label:
            found.append(Member(len(found) + 1, label, " ".join(notes) or None, amount, flag))
        bare, notes, quoted, flag, lead, gap = [], [], None, None, "", False

    def add(piece: str) -> None:
        nonlocal lead, gap
        bare.append(piece)
        if piece.isspace():
            gap = True
        elif len(lead) <= 3:
            lead = f"{lead} {piece.lstrip()}" if lead and (gap or piece[0].isspace()) else lead + piece.lstrip()
            gap = piece[-1].isspace()

    while at < end:
        if m := _PLAIN.match(text, at):
            add(m.group())
            at = m.end()
            continue
        c = text[at]
        if (to := _separator(text, at)) is not None:
            finish()
            at = to
            continue
        if c in QUOTES:
            opens = quoted is None and lead.rstrip().lower() in ("", "and")
            if opens and c not in hopeless and (q := _quoted(text, at)) is not None:
                quoted, at = q
                continue
            if opens and text.find(QUOTES[c], at + 1) < 0:
                hopeless.add(c)
            if opens:
                flag = "unbalanced_quote"
        elif c in BRACKETS:
            if (to := brackets.get(at)) is not None:
                notes.append(text[at + 1 : to - 1].strip())
                at = to
                continue
            flag = "unbalanced_bracket"
        to = at + 1
        while c == " " and to < end and text[to] == " ":
            to += 1  # no separator begins within a run of blanks if none does at its first
        add(text[at:to])
        at = to
    finish()
    return found


MEMBER = T.ArrayType(T.StructType([
    T.StructField("list_position", T.IntegerType()),
    T.StructField("label", T.StringType()),
    T.StructField("note", T.StringType()),
    T.StructField("amount", T.StringType()),
    T.StructField("flag", T.StringType()),
]))


@F.pandas_udf(MEMBER)
def unpack(texts: pd.Series) -> pd.Series:
    """Members of each text."""
    return pd.Series([members(t) if isinstance(t, str) else [] for t in texts], dtype=object)


@F.pandas_udf(T.ArrayType(T.StringType()))
def unpack_labels(texts: pd.Series) -> pd.Series:
    """Labels of the members of each text, in order."""
    return pd.Series([[m.label for m in members(t)] if isinstance(t, str) else [] for t in texts], dtype=object)


#: Fields that hold lists (fixed values).
LIST_FIELDS = ("Ethnic groups", "Languages", "Religions", "Border countries", "Export partners")


def explode_members(df: DataFrame, key: Sequence[str], text: str, least: int = 1) -> DataFrame:
    """One row per member of the texts that hold at least `least`: key columns, list_position, label, note, amount, flag."""
    # marked as not deterministic so that the filter doesn't run the parser a second time
    lists = df.select(*key, unpack.asNondeterministic()(F.col(text)).alias("_m")).where(F.size("_m") >= least)
    return lists.select(*key, F.inline("_m"))


def explode_labels(df: DataFrame, key: Sequence[str], text: Column | str, least: int = 1) -> DataFrame:
    """As explode_members, with list_position and label only; less data crosses to and from Python."""
    text = F.col(text) if isinstance(text, str) else text
    lists = df.select(*key, unpack_labels.asNondeterministic()(text).alias("_m")).where(F.size("_m") >= least)
    return lists.select(*key, F.posexplode("_m").alias("_p", "label")).select(*key, (F.col("_p") + 1).alias("list_position"), "label")
