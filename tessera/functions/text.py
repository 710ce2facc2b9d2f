"""Text search and similarity as native columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: English words that are no search terms (fixed values).
STOPWORDS = tuple("a an and are as at be but by for from had has have he her his i if in into is it its no not of on or she so such that the their then there these they this to was we were which will with you".split())


def tokens(text: Column) -> Column:
    """Lower-case words of letters and digits."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), 0)


def _cut(word: Column, n: int) -> Column:
    return F.substr(word, F.lit(1), F.length(word) - n)


def stem(word: Column) -> Column:
    """A light English stem: plural, -ed and -ing endings. Endings are compared, patterns only tried where one fits."""
    ends = lambda *e: F.right(word, F.lit(max(map(len, e)))).isin(*e) if len({*map(len, e)}) == 1 else None
    plural = (
        F.when(~word.endswith("s") | ends("ss", "us", "is"), word).when(word.endswith("ies"), F.concat(_cut(word, 3), F.lit("y")))
        .when(word.endswith("es") & (word.endswith("shes") | word.endswith("ches") | word.endswith("xes") | word.endswith("zes") | word.endswith("sses")), _cut(word, 2)).otherwise(_cut(word, 1))
    )
    bare = (
        F.when(plural.endswith("ing") & (F.length(plural) > 5) & plural.rlike("[aeiou].*ing$"), _cut(plural, 3))
        .when(plural.endswith("ed") & (F.length(plural) > 4) & plural.rlike("[aeiou].*ed$"), _cut(plural, 2)).otherwise(plural)
    )
    return F.when(F.length(word) <= 3, word).otherwise(bare)


def terms(text: Column) -> Column:
    """Stems of the words that are search terms, in order."""
    return F.transform(F.filter(tokens(text), lambda t: ~t.isin(*STOPWORDS)), stem)


def trigrams(text: Column) -> Column:
    """The set of trigrams of the words of a text, each padded with two blanks before and one after."""
    padded = F.transform(tokens(text), lambda w: F.concat(F.lit("  "), w, F.lit(" ")))
    grams = F.transform(padded, lambda w: F.transform(F.sequence(F.lit(1), F.length(w) - 2), lambda i: F.substring(w, i, 3)))
    return F.array_distinct(F.flatten(grams))


def similarity(a: Column, b: Column) -> Column:
    """Shared trigrams over all trigrams of two trigram sets; 0 where both are empty."""
    return F.coalesce(F.size(F.array_intersect(a, b)) / F.nullif(F.size(F.array_union(a, b)), F.lit(0)), F.lit(0.0))


def escape_pipes(text: Column) -> Column:
    """Text for a Markdown table cell."""
    return F.regexp_replace(text, r"\|", r"\\|")


def anchor(text: Column) -> Column:
    """A Markdown heading's anchor."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(text)), r"[^\p{L}\p{N}\s-]", ""), r"\s", "-")
