"""Quantities recorded in different units: segmentation of unit strings by dynamic programming.

What stands beside the number of a published value ("an estimated … thous. sq. kilometres", "€ … bn", "births per
100,000 inhabitants") is segmented as a whole by dynamic programming over tries of qualifiers, scale words, currency
marks, exponents, prefixes and roots. A decomposition must cover the whole string; among several, the score decides:
longer pieces first, and a prior for decompositions whose dimension is that of the field. "pounds" is a mass in a
field of masses and money in a field of money, "m" a metre or a million, "kt" a kilotonne.

An amount is null, with a reason, when the value is absent, a note, has letters among its digits, or when the string
beside the number can't be covered or has another dimension than the field. With no unit anywhere the base unit is
meant. Scale words in the text win over scale_word; units in the text over unit_hint and currency.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping
from functools import lru_cache
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialise, small

# ---- vocabulary (fixed values) --------------------------------------------------------------------------------------

SCALES = {
    "hundred": 1e2, "thousand": 1e3, "thousands": 1e3, "thous": 1e3, "thous.": 1e3, "k": 1e3, "million": 1e6, "millions": 1e6, "mil": 1e6, "mil.": 1e6,
    "mill.": 1e6, "mn": 1e6, "mn.": 1e6, "mio": 1e6, "mio.": 1e6, "m": 1e6, "mm": 1e6, "billion": 1e9, "billions": 1e9, "bn": 1e9, "bn.": 1e9, "bil.": 1e9, "b": 1e9,
    "trillion": 1e12, "trillions": 1e12, "tn": 1e12, "tn.": 1e12, "trn": 1e12,
}
#: Scale words so short that they only count where a unit reading fails or the field is money or a count.
SHORT_SCALES = {"k", "m", "mm", "b"}
CURRENCIES = {
    "$": "usd", "us$": "usd", "usd": "usd", "dollar": "usd", "dollars": "usd", "us dollars": "usd", "us dollar": "usd", "€": "eur", "eur": "eur", "euro": "eur", "euros": "eur",
    "£": "gbp", "gbp": "gbp", "pound": "gbp", "pounds": "gbp", "pound sterling": "gbp", "pounds sterling": "gbp", "sterling": "gbp",
    "¥": "jpy", "jpy": "jpy", "yen": "jpy", "￥": "jpy",
}
#: Spelling of a root -> (symbol, dimension of length the root carries: 1 can take an exponent, 0 can't).
ROOTS = {
    "m": ("m", 1), "metre": ("m", 1), "metres": ("m", 1), "meter": ("m", 1), "meters": ("m", 1),
    "ft": ("ft", 1), "ft.": ("ft", 1), "foot": ("ft", 1), "feet": ("ft", 1), "mi": ("mi", 1), "mi.": ("mi", 1), "mile": ("mi", 1), "miles": ("mi", 1),
    "statute mile": ("mi", 1), "statute miles": ("mi", 1), "kms": ("km", 1), "nmi": ("nmi", 0), "nm": ("nmi", 0), "nautical mile": ("nmi", 0), "nautical miles": ("nmi", 0),
    "ha": ("ha", 0), "hectare": ("ha", 0), "hectares": ("ha", 0), "ac": ("acre", 0), "ac.": ("acre", 0), "acre": ("acre", 0), "acres": ("acre", 0),
    "wh": ("wh", 0), "watt hour": ("wh", 0), "watt hours": ("wh", 0), "j": ("j", 0), "joule": ("j", 0), "joules": ("j", 0),
    "t": ("t", 0), "tonne": ("t", 0), "tonnes": ("t", 0), "ton": ("t", 0), "tons": ("t", 0), "metric ton": ("t", 0), "metric tons": ("t", 0),
    "g": ("g", 0), "gram": ("g", 0), "grams": ("g", 0), "kilo": ("kg", 0), "kilos": ("kg", 0), "lb": ("lb", 0), "lb.": ("lb", 0), "lbs": ("lb", 0), "lbs.": ("lb", 0), "pound": ("lb", 0), "pounds": ("lb", 0),
    "short ton": ("short_ton", 0), "short tons": ("short_ton", 0), "bbl": ("bbl", 0), "bbl.": ("bbl", 0), "barrel": ("bbl", 0), "barrels": ("bbl", 0),
    "person": ("person", 0), "persons": ("person", 0), "people": ("person", 0), "inhabitant": ("person", 0), "inhabitants": ("person", 0), "resident": ("person", 0), "residents": ("person", 0),
    "percent": ("percent", 0), "per cent": ("percent", 0), "%": ("percent", 0), "pct": ("percent", 0), "per hundred": ("percent", 0), "per 100": ("percent", 0), "per mille": ("per_1000", 0), "‰": ("per_1000", 0), "per thousand": ("per_1000", 0), "per 1,000": ("per_1000", 0), "per 1000": ("per_1000", 0), "per 1 000": ("per_1000", 0), "/1,000": ("per_1000", 0), "/1000": ("per_1000", 0),
    "per 100,000": ("per_100000", 0), "per 100000": ("per_100000", 0), "per 100 000": ("per_100000", 0), "per hundred thousand": ("per_100000", 0), "/100,000": ("per_100000", 0), "/100000": ("per_100000", 0),
}
PREFIXES = {"k": 1e3, "kilo": 1e3, "mega": 1e6, "giga": 1e9, "tera": 1e12, "m": 1e6, "g": 1e9, "t": 1e12, "c": 1e-2, "centi": 1e-2, "milli": 1e-3, "h": 1e2, "hecto": 1e2}
PREFIX_SYMBOL = {"k": "k", "kilo": "k", "mega": "m", "giga": "g", "tera": "t", "m": "m", "g": "g", "t": "t", "c": "c", "centi": "c", "milli": "milli", "h": "h", "hecto": "h"}
#: Roots a prefix can stand before; a one-letter "m" is mega, so never before a metre.
PREFIXABLE = {"m": {"k", "kilo", "c", "centi", "milli"}, "wh": {"k", "kilo", "mega", "giga", "tera", "m", "g", "t"}, "j": {"k", "kilo", "mega", "giga", "tera", "m", "g", "t"}, "g": {"k", "kilo", "milli"}, "t": {"k", "kilo", "mega", "m"}}
POWERS_BEFORE = {"square": 2, "sq": 2, "sq.": 2, "cubic": 3, "cu": 3, "cu.": 3}
POWERS_AFTER = {"2": 2, "²": 2, "^2": 2, "3": 3, "³": 3, "^3": 3, "squared": 2, "cubed": 3}
QUALIFIERS = (
    "about", "approximately", "approx", "approx.", "around", "circa", "ca.", "c.", "some", "roughly", "nearly", "almost", "over", "under", "an estimated", "estimated", "est.", "in all", "in total", "total", "total of", "totalling", "totaling", "~", "≈",
)
#: Words that say what is counted in a rate.
FILLERS = ("births", "deaths", "births/", "population", "inhabitants", "persons", "people", "residents", "of population", "of", "live births")
ABSENT = {"", "-", "--", "na", "n/a", "n.a.", "n.a", "negl", "negl.", "negligible", "none", "none reported", "not available", "unknown"}


class Reading(NamedTuple):
    unit: str | None
    power: float
    scale: float | None


def _trie(words) -> dict:
    root: dict = {}
    for w in words:
        node = root
        for c in w:
            node = node.setdefault(c, {})
        node[""] = w
    return root


def _prefixes(trie: dict, text: str, at: int):
    """All words of the trie that begin at `at`."""
    node = trie
    for k in range(at, len(text)):
        node = node.get(text[k])
        if node is None:
            return
        if "" in node:
            yield node[""]


_T = {name: _trie(words) for name, words in {"scale": SCALES, "money": CURRENCIES, "root": ROOTS, "prefix": PREFIXES, "before": POWERS_BEFORE, "after": POWERS_AFTER, "word": QUALIFIERS, "filler": FILLERS}.items()}


@lru_cache(maxsize=200_000)
def segment(text: str, kind: str, known: tuple[tuple[str, str], ...]) -> Reading | None:
    """The best decomposition of a whole string beside a number, or None. known: (unit code, its quantity kind).

    The dynamic program runs over positions; a state also says whether a unit and a scale were read. Score: characters
    in pieces squared (few long pieces win), a prior of 1000 for a unit of the field's kind.
    """
    text = re.sub(r"(?<=[a-z])-(?=[a-z])", " ", " ".join(text.lower().split()))
    kinds = dict(known)
    n = len(text)
    # best[i][(unit, power, scale)] = score; unit "" while none was read
    best: list[dict[tuple, float]] = [{} for _ in range(n + 1)]
    best[0][("", 1.0, 0.0)] = 0.0

    def put(i: int, state: tuple, score: float) -> None:
        if score > best[i].get(state, -math.inf):
            best[i][state] = score

    def boundary(i: int, piece: str) -> bool:
        """A piece that ends in a letter must end a word."""
        return i >= n or not (piece[-1].isalpha() and text[i].isalpha())

    def units(at: int):
        """(end, code, power of ten before the code's factor) of the unit expressions at `at`."""
        def tail(i: int, prefix: str, root: str, power: int):
            symbol, takes = ROOTS[root]
            ends = [(i, power)]
            if takes and power == 1:
                ends += [(i + len(a), POWERS_AFTER[a]) for a in _prefixes(_T["after"], text, i)]
            for e, p in ends:
                if e < n and text[e].isalpha() and text[e - 1].isalpha():
                    continue
                yield e, prefix, symbol, p

        def body(i: int, power: int):
            for root in _prefixes(_T["root"], text, i):
                yield from tail(i + len(root), "", root, power)
            for pre in _prefixes(_T["prefix"], text, i):
                for root in _prefixes(_T["root"], text, i + len(pre)):
                    if pre in PREFIXABLE.get(ROOTS[root][0], ()) and (len(pre) > 1) == (len(root) > 2 and root != "wh"):
                        yield from tail(i + len(pre) + len(root), pre, root, power)

        yield from body(at, 1)
        for w in _prefixes(_T["before"], text, at):
            i = at + len(w)
            yield from body(i + (i < n and text[i] == " "), POWERS_BEFORE[w])

    def coded(prefix: str, symbol: str, p: int) -> tuple[str, float] | None:
        """(code in the reference, factor beside the reference's), trying the prefixed code first."""
        sign = PREFIX_SYMBOL.get(prefix, "")
        tailed = f"{p}" if p > 1 else ""
        if f"{sign}{symbol}{tailed}" in kinds:
            return f"{sign}{symbol}{tailed}", 1.0
        base = f"{symbol}{tailed}"
        if base in kinds:
            return base, PREFIXES.get(prefix, 1.0) ** p
        for other, value in PREFIXES.items():  # the root only stands in the reference with another prefix: wh in kwh
            c = f"{PREFIX_SYMBOL[other]}{symbol}{tailed}"
            if c in kinds:
                return c, (PREFIXES.get(prefix, 1.0) / value) ** p
        return None

    for i in range(n):
        for (unit, power, scale), score in list(best[i].items()):
            if text[i] == " ":
                put(i + 1, (unit, power, scale), score)
                continue
            if i and text[i].isalpha() and text[i - 1].isalpha():
                continue
            for w in _prefixes(_T["word"], text, i):
                if boundary(i + len(w), w):
                    put(i + len(w), (unit, power, scale), score + len(w) ** 2)
            for code in known:
                w = code[0]
                if not unit and text.startswith(w, i) and boundary(i + len(w), w):
                    put(i + len(w), (w, 1.0, scale), score + len(w) ** 2 + 1000 * (kinds[w] == kind))
            if kind == "rate":
                for w in _prefixes(_T["filler"], text, i):
                    if boundary(i + len(w), w):
                        put(i + len(w), (unit, power, scale), score + len(w) ** 2)
            if not scale:
                for w in _prefixes(_T["scale"], text, i):
                    if boundary(i + len(w), w):
                        short = w in SHORT_SCALES and kind not in ("money", "count")
                        put(i + len(w), (unit, power, SCALES[w]), score + (-50 if short else len(w) ** 2))
            for w in _prefixes(_T["money"], text, i):
                if boundary(i + len(w), w) and "money" in kinds.values() and CURRENCIES[w] in kinds and unit in ("", CURRENCIES[w]):
                    put(i + len(w), (CURRENCIES[w], 1.0, scale), score + len(w) ** 2 + 1000 * (kind == "money" and not unit))
            if not unit:
                for e, prefix, symbol, p in units(i):
                    if found := coded(prefix, symbol, p):
                        put(e, (found[0], found[1], scale), score + (e - i) ** 2 + 1000 * (kinds[found[0]] == kind))
    ends = sorted(best[n].items(), key=lambda x: (-x[1], x[0]))
    if not ends:
        return None
    (unit, power, scale), _ = ends[0]
    return Reading(unit or None, power, scale or None)


# ---- numbers --------------------------------------------------------------------------------------------------------

_SPACE = " \u00a0\u2009\u202f\u2007"
_NUMBER = re.compile(rf"(?<![\w.,'’])([-−–+]?)(\d[\d.,'’{_SPACE}]*\d|\d|\.\d+)(?:\s*(?:[x×*]\s*10\s*\^?\s*([-−]?\d+|[⁻⁰¹²³⁴-⁹]+)|[eE]([-+]?\d+)(?![\w])))?")
_RATE = re.compile(rf"(?:per|/)\s*1(?:\d\d?)?[, {_SPACE}]?0*(?:0{{2,3}})\b", re.I)
_NOTE = re.compile(r"\([^()]*\)|\[[^\[\]]*\]")
_RAISED = str.maketrans("⁻⁰¹²³⁴⁵⁶⁷⁸⁹", "-0123456789")


def read_digits(digits: str) -> float | None:
    """The number written with any grouping: 1,234.5 / 1.234,5 / 1'234 / 1 234 / 56.109.500 / 800,59."""
    plain = re.sub(rf"[{_SPACE}'’]", "", digits)
    if plain != digits and not re.fullmatch(rf"\d{{1,3}}(?:[{_SPACE}'’]\d{{3}})+(?:[.,]\d+)?", digits):
        return None
    commas, points = plain.count(","), plain.count(".")
    if commas and points:
        decimal, group = (".", ",") if plain.rfind(".") > plain.rfind(",") else (",", ".")
        if plain.count(decimal) > 1 or not re.fullmatch(rf"\d{{1,3}}(?:\{group}\d{{3}})+\{decimal}\d+", plain):
            return None
        return float(plain.replace(group, "").replace(decimal, "."))
    if commas:
        if re.fullmatch(r"\d{1,3}(?:,\d{3})+", plain) and plain == digits:
            return float(plain.replace(",", ""))
        return float(plain.replace(",", ".")) if commas == 1 else None
    if points > 1:
        return float(plain.replace(".", "")) if re.fullmatch(r"\d{1,3}(?:\.\d{3})+", plain) else None
    return float(plain)


class Amount(NamedTuple):
    amount: float | None
    unit: str | None
    reason: str | None


def read_amount(raw: str | None, hint: str | None, scale_word: str | None, currency: str | None, kind: str | None, base: str | None, factors: Mapping[str, float], known: tuple) -> Amount:
    """The amount of one claim in the base unit of its metric, the unit it was read in, or the reason it has none."""
    if raw is None or raw.strip().lower() in ABSENT:
        return Amount(None, None, "absent")
    if kind is None or base is None:
        return Amount(None, None, "unknown_metric")
    text = _NOTE.sub(" ", raw)
    found = [m for m in _NUMBER.finditer(text) if not _RATE.search(text[max(0, m.start() - 5) : m.end()])]
    if not found:
        return Amount(None, None, "no_number_found")
    if len(found) > 1:
        return Amount(None, None, "several_numbers")
    m = found[0]
    value = read_digits(m[2].rstrip(_SPACE))
    if value is None:
        return Amount(None, None, "number_unparseable")
    if m[1] in ("-", "−", "–") and m[1]:
        value = -value
    if e := m[3] or m[4]:
        value *= 10.0 ** int(e.translate(_RAISED).replace("−", "-").replace("+", ""))
    beside = segment(f"{text[: m.start()]} {text[m.end() :]}".strip(" ,;:"), kind, known)
    if beside is None:
        return Amount(None, None, "explanatory_note_not_a_value")
    unit, power, scale = beside
    if hint and hint.strip():
        hinted = segment(hint.strip(), kind, known)
        if hinted is None and unit is None:
            return Amount(None, None, "unknown_unit")
        if hinted is not None:
            if unit is None:
                unit, power = hinted.unit, hinted.power
            scale = scale or hinted.scale
    if unit is None and currency and currency.strip():
        unit, power = CURRENCIES.get(currency.strip().lower(), currency.strip().lower()), 1.0
        if unit not in factors:
            return Amount(None, None, "unknown_unit")
    if scale is None and scale_word and scale_word.strip():
        scale = SCALES.get(scale_word.strip().lower())
        if scale is None:
            return Amount(None, None, "unknown_scale")
    unit = unit or base
    kinds = dict(known)
    if kinds.get(unit) != kind:
        return Amount(None, unit, "other_dimension")
    amount = value * (scale or 1.0) * power * factors[unit] / factors[base]
    return Amount(amount, unit, None) if math.isfinite(amount) else Amount(None, unit, "out_of_range")


AMOUNT = T.StructType([T.StructField("amount", T.DoubleType()), T.StructField("unit", T.StringType()), T.StructField("reason", T.StringType()), T.StructField("base", T.StringType())])


def amount_column(metrics: Mapping[str, tuple[str, str]], units: Mapping[str, tuple[str, float]]):
    """A function of the columns (raw, unit_hint, scale_word, currency, metric_code) that gives the AMOUNT struct."""
    known = tuple(sorted((code, kind) for code, (kind, _) in units.items()))
    factors = {code: factor for code, (_, factor) in units.items()}

    @F.pandas_udf(AMOUNT)
    def amount(raw: pd.Series, hint: pd.Series, scale: pd.Series, currency: pd.Series, metric: pd.Series) -> pd.DataFrame:
        text = lambda v: v if isinstance(v, str) else None
        out = [(*read_amount(text(r), text(h), text(s), text(c), *metrics.get(m, (None, None)), factors, known), metrics.get(m, (None, None))[1]) for r, h, s, c, m in zip(raw, hint, scale, currency, metric)]
        return pd.DataFrame(out, columns=["amount", "unit", "reason", "base"], dtype=object)

    return amount


def normalise(claims: DataFrame, metric: DataFrame, unit_reference: DataFrame, most: int = 10_000) -> DataFrame:
    """claims with base_amount, read_unit, amount_reason and base_unit added.

    metric and unit_reference are reference tables of at most `most` rows, checked; they go into the function itself.
    Nulls in any column give a null amount with a reason, never an error. Columns of these names are replaced.
    """
    metrics = {r.metric_code: (r.quantity_kind, r.base_unit) for r in small(metric.select("metric_code", "quantity_kind", "base_unit"), most, "metric")}
    units = {r.unit_code: (r.quantity_kind, r.factor_to_base) for r in small(unit_reference.select("unit_code", "quantity_kind", "factor_to_base"), most, "unit_reference") if r.unit_code and r.factor_to_base is not None}
    read = amount_column(metrics, units)
    with_amount = claims.withColumn("_a", read(*(F.col(c).cast("string") for c in ("raw", "unit_hint", "scale_word", "currency", "metric_code"))))
    return with_amount.withColumns({
        "base_amount": F.col("_a.amount"), "read_unit": F.col("_a.unit"), "amount_reason": F.col("_a.reason"),
        "base_unit": F.col("_a.base"),
    }).drop("_a")


#: Members of a class that meet those of another in one task.
BLOCK = 1_000


class EqualAmounts:
    """Rows of one key whose amounts differ by less than `tolerance` of the larger, as classes of rows and links between classes.

    A class holds the rows of one key with the very same amount, so copies, however many, are one row of the join. It is
    a band join: |amount| falls into logarithmic bands a tolerance wide, so partners lie in the same or the next band and
    classes meet by (key, sign, band) only. Zeros and nulls have no partners and no class.

    Classes of more than BLOCK rows are split by their ids into blocks of about BLOCK, so no group is unbounded; blocks
    carry the ids of their rows through the join. Ids are unique.
    """

    def __init__(self, amounts: DataFrame, key: list[str], id_column: str, amount: str, tolerance: float = 0.005):
        self.id, self.key = id_column, key
        width = -math.log1p(-tolerance) * 1.0001
        self.rows = amounts.where(F.col(amount).isNotNull() & (F.col(amount) != 0)).select(*key, F.col(amount).alias("_a"), F.col(id_column).alias("_id"))
        of_class = [*key, "_a"]
        # only classes of more than BLOCK rows come out, so the join is with a short table
        large = self.rows.groupBy(*of_class).agg(F.count("*").alias("_n")).where(F.col("_n") > BLOCK).select(*of_class, F.ceil(F.col("_n") / BLOCK).cast("int").alias("_blocks"))
        block = F.pmod(F.xxhash64("_id"), F.coalesce("_blocks", F.lit(1))).cast("int")
        grouped = self.rows.join(materialise(large), of_class, "left").groupBy(*of_class, block.alias("block")).agg(F.collect_list("_id").alias("ids"))
        self.blocks = materialise(grouped.select("*", F.abs("_a").alias("_v"), F.signum("_a").cast("int").alias("_s"), F.floor(F.log(F.abs("_a")) / width).alias("_b")))
        self._tolerance = tolerance

    def _met(self, blocks: DataFrame, *carried: str) -> DataFrame:
        """Pairs of blocks of different classes that agree, each once, with the carried columns of both as <name>_a and <name>_b."""
        sides = [blocks.select(*self.key, "_s", "_b", F.col("_v").alias(f"_v{x}"), *(F.col(c).alias(f"{c}_{x}") for c in carried)) for x in "ab"]
        left = sides[0].withColumn("_own", F.col("_b")).withColumn("_b", F.explode(F.array("_b", F.col("_b") + 1)))
        near = F.abs(F.col("_va") - F.col("_vb")) < self._tolerance * F.greatest("_va", "_vb")
        once = (F.col("_own") != F.col("_b")) | (F.col("_va") < F.col("_vb"))  # within a band the smaller amount comes first
        return left.join(sides[1], [*self.key, "_s", "_b"]).where(near & once)

    def counted(self) -> DataFrame:
        """One row per row with an amount: <id>, class_id (the least id of its class), copies (rows of its class), links (rows it agrees with)."""
        of_class = [*self.key, "_a"]
        classes = self.blocks.groupBy(*of_class, "_s", "_b", "_v").agg(F.min(F.array_min("ids")).alias("class_id"), F.sum(F.size("ids")).alias("copies"))
        links = materialise(self._met(classes, "class_id", "copies").select("class_id_a", "class_id_b", "copies_a", "copies_b"))
        both = links.select(F.col("class_id_a").alias("class_id"), F.col("copies_b").alias("n")).unionByName(links.select(F.col("class_id_b").alias("class_id"), F.col("copies_a").alias("n")))
        counted = classes.join(both.groupBy("class_id").agg(F.sum("n").alias("_n")), "class_id", "left")
        wide = self.blocks.select(*of_class, "ids").join(counted.select(*of_class, "class_id", "copies", (F.col("copies") - 1 + F.coalesce("_n", F.lit(0))).alias("links")), of_class)
        return wide.select(F.explode("ids").alias(self.id), "class_id", "copies", "links")

    def pairs(self) -> DataFrame:
        """Every pair (a < b) of rows: links and classes expanded, by blocks."""
        of_class = [*self.key, "_a"]
        apart = self._met(self.blocks, "ids").select("ids_a", "ids_b")
        alone = self.blocks.where(F.size("ids") > 1).select(F.col("ids").alias("ids_a"), F.col("ids").alias("ids_b"))
        split = self.blocks.select(*of_class, "block", "ids").join(self.blocks.where("block > 0").select(*of_class).distinct(), of_class, "left_semi")
        blocks = [split.select(*of_class, F.col("block").alias(f"_k{x}"), F.col("ids").alias(f"ids_{x}")) for x in "ab"]
        across = blocks[0].join(blocks[1], of_class).where("_ka < _kb").select("ids_a", "ids_b")
        one = F.explode("ids_a").alias("_ia")
        expand = lambda df, same: df.select(one, "ids_b").select("_ia", F.explode(F.filter("ids_b", lambda i: i > F.col("_ia")) if same else F.col("ids_b")).alias("_ib"))
        found = expand(apart, False).unionByName(expand(across, False)).unionByName(expand(alone, True))
        return found.select(F.least("_ia", "_ib").alias(f"{self.id}_a"), F.greatest("_ia", "_ib").alias(f"{self.id}_b"))


#: Columns that name what a claim is about.
CLAIM_KEY = ("dataset_code", "source_key", "metric_code", "reference_year")


def agreeing_claims(parsed_value: DataFrame, metric: DataFrame, unit_reference: DataFrame) -> EqualAmounts:
    """Claims about the same thing with the same amount; rows with a null in the key agree with none."""
    claims = parsed_value.dropna(subset=list(CLAIM_KEY)).select("parsed_value_id", *CLAIM_KEY, "raw", "unit_hint", "scale_word", "currency")
    # amounts are worked out once, as a narrow table in the shared folder
    amounts = materialise(normalise(claims, metric, unit_reference).select("parsed_value_id", *CLAIM_KEY, "base_amount"))
    return EqualAmounts(amounts, list(CLAIM_KEY), "parsed_value_id", "base_amount")
