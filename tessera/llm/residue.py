"""Template residue and error-page text in documents.

Responses served in place of content are learned from the corpus, in any language; no sentence of theirs is written here:

1. A text is cut into segments (sentences, lines, parts between dashes), without case, punctuation, numbers and reference
   codes. What stands in quotation marks is reported speech and belongs to no segment.
2. A body is of low information if it is short against the texts of its host (its source) and of the corpus, or if
   different addresses (title and source key) serve the same body.
3. Address slug (source key, section), title and body terms are compared: a body that shares no term with them is apart.
4. Of every segment that such bodies repeat at different addresses, the addresses where it stands in a body of low
   information are weighed against those where it stands among ordinary text, by how much of its host's text is of low
   information. A response fills whole pages far more often than a host's sentences do. The log-likelihood ratio must
   exceed the logarithm of the number of segments in bodies of low information, so the bar rises with the corpus as chance findings do.
   Most low-information bodies of the segment must be apart, and no address may hold more than half of its copies.
5. A document with such a segment anywhere, or with a detector's finding, has residue.

Detectors read one text: placeholders (tokens of template languages, bracketed instructions, what a failed filling
leaves), filler (runs of repeated words; pseudo-Latin, words that begin like those of the standard passage) and coded
errors (a status code after its word, a traceback). A response that stands at one address only isn't found by 4.

Null, empty and blank texts are no cases. Control strings of tokenizers, odd characters and foreign scripts are no
evidence. Texts are read whole and once. Repeated rows are judged alike, null titles, keys and hosts are one of each.
"""

from __future__ import annotations

import re
from operator import eq

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialise

# ---- detectors --------------------------------------------------------------------------------------------------------

#: The words of the standard filler passage.
FILLER_PASSAGE = (
    "lorem ipsum dolor sit amet consectetur adipiscing elit sed eiusmod tempor incididunt labore dolore magna aliqua enim minim veniam quis nostrud exercitation ullamco laboris nisi aliquip commodo "
    "consequat duis aute irure reprehenderit voluptate velit esse cillum fugiat nulla pariatur excepteur sint occaecat cupidatat proident sunt culpa officia deserunt mollit anim est laborum"
)
_BEGINNINGS = frozenset(w[:3] for w in FILLER_PASSAGE.split())

#: What must stand in a text -> the placeholders that hold it; a text without the first is never searched for the second.
_PLACEHOLDERS = tuple(
    (mark, re.compile(pattern))
    for mark, pattern in (
        ("{", r"\{\{[^{}\n]*\}\}|\{%[^{}\n]*%\}|\$\{[^{}\n]+\}|#\{[^{}\n]+\}|(?<![{$#\w])\{[A-Za-z_][\w.]*\}|\{%|\{\{ "),
        ("%", r"<%[^<>\n]*%>|<%=|%\}|%\([\w.]+\)[sd]|(?<![\w%])%[A-Z][A-Z_]*(?:\.[A-Z_]+)?%(?!\w)|(?<![\w%])%[sd](?![\w%])"),
        ("@@", r"@@[\w.]+@@"), ("[[", r"\[\[[A-Z][A-Z0-9_.]*\]\]"), ("__", r"(?<!\w)__[A-Z][A-Z0-9]*(?:[_.][A-Z0-9]+)*__(?!\w)"),
        ("#", r"#REF!|#(?:NAME|VALUE)\?"), ("[object", r"\[object Object\]"), ("XX", r"\bXX\.X\b"), ("TODO", r"\bTODO:"), ("undefined", r"(?<![\w-])undefined(?![\w-])"), ("NaN", r"\bNaN\b"),
        ("&lt;", r"&lt;(?:name|title|text|your [^&]+)&gt;"),
    )
)
_INSTRUCTION = re.compile(
    r"\[(?:insert|enter|your|add|name of|tbd|tba|todo|fill in|placeholder|hier einfügen|name ergänzen|bitte ergänzen|ihr text|à compléter|insérer|votre texte|por completar|inserte|insertar|su texto)\b[^\[\]\n]*\]"
    r"|<(?:add|insert|enter|your|votre|ihre?|su|nombre|nom|name)\b(?: [^<>=\n]+)?>",
    re.I,
)
_NONE = re.compile(r"(?<![.!?…\n\"“«] )(?<=\S )None(?! of\b)(?=[\s.,;]|$)")
_CODED = re.compile(r"(?:^|[\n.!?…—]\s*|\s{2,})(?:http |status )?(?:error|fehler|erreur|http error)[ :]+[45]\d\d\b(?! [\w]* ?percent)|\btraceback(?: \(most recent call last\))?: ?(?:\w+error\b)?|\b\w+error: '", re.I)
_UNIT = re.compile(r"(.)\1{3,}|(.{2,4})\2{2,}")


def repeated_words(words: list[str]) -> bool:
    """A run of one word or pair of words four times or more (three of a word that is itself a repetition)."""
    for period in (1, 2):
        if not any(map(eq, words, words[period:])):
            continue
        run = 0
        for a, b in zip(words, words[period:]):
            run = run + 1 if a == b else 0
            if run and period == 1 and (run >= 3 or run >= 2 and len(a) >= 4 and _UNIT.fullmatch(a)):
                if not any(ord(c) > 0x2000 for c in a):
                    return True
            if period == 2 and run >= 6 and all(x.isascii() and x.isalpha() and len(x) > 1 for x in (a, words[0])):
                return True
    return False


def pseudo_latin(words: list[str]) -> bool:
    """A run of four words, three of them different, that begin like words of the standard filler passage."""
    run: list[str] = []
    for w in words:
        if w[:3] not in _BEGINNINGS:
            run = []
            continue
        run.append(w.strip(".,;:!?"))
        if len(run) >= 4 and len(set(run[-4:])) >= 3 and all(x.isalpha() for x in run[-4:]):
            return True
    return False


def evidence(text: str | None) -> list[str]:
    """What the detectors find in a text, sorted: error, filler, placeholder."""
    if not text or not text.strip():
        return []
    found = set()
    if any(mark in text and pattern.search(text) for mark, pattern in _PLACEHOLDERS) or ("[" in text or "<" in text) and _INSTRUCTION.search(text) or "None" in text and _NONE.search(text):
        found.add("placeholder")
    low = text.lower()
    if ("error" in low or "fehler" in low or "erreur" in low or "traceback" in low) and _CODED.search(low):
        found.add("error")
    words = low.split()
    if repeated_words(words) or pseudo_latin(words):
        found.add("filler")
    return sorted(found)


# ---- segments ---------------------------------------------------------------------------------------------------------

#: Steps from a text to lines of words, one line a segment: (pattern of the linear-time engine, what takes its place).
_STEPS = (
    (r"""(^|[^\pL\pN])["“„«‹][^"“”„«»‹›\r\n]*["”“»›]""", r'\1"'),
    (r"""[.!?…。]+["”»’')\]]*(?:[\s\x{a0}\x{202f}]+|$)|[\r\n\x0b\x0c\x{85}\x{2028}\x{2029}]+|\s(?:[—–|-]\s|\s+)""", "\n"),
    (r"[\pL_]*\pN[\pL\pN_]*", " "),
    (r"[^\pL\pM\pN\n ]+", " "),
    (r" +", " "),
    (r" ?\n[ \n]*", "\n"),
)
#: A line up to its first inner capital, and from its last: sentences that run together without a mark meet at a capital.
_BEGINNING, _END = r"(?m)^([^\n]*?) \p{Lu}[^\n]*$", r"(?m)^[^\n]* (\p{Lu}[^\n]*)$"


def segments(texts: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array]:
    """(lines, beginnings, ends) of texts: the segments of each, their words parted by blanks, one a line."""
    for pattern, instead in _STEPS:
        texts = pc.replace_substring_regex(texts, pattern, instead)
    lines = pc.utf8_trim(texts, " \n")
    cut = [pc.replace_substring_regex(lines, pattern, r"\1") for pattern in (_BEGINNING, _END)]
    return tuple(pc.utf8_lower(x) for x in (lines, *cut))


SEEN = T.StructType([T.StructField("kinds", T.ArrayType(T.StringType())), *(T.StructField(name, T.ArrayType(T.StringType())) for name in ("segs", "begins", "ends"))])


@F.arrow_udf(SEEN)
def look(texts: pa.Array) -> pa.Array:
    """Detectors' findings and segments of each text."""
    kinds = pa.array([evidence(t) for t in texts.to_pylist()], pa.list_(pa.string()))
    return pa.StructArray.from_arrays([kinds, *(pc.split_pattern(x, "\n") for x in segments(texts.cast(pa.string())))], ["kinds", "segs", "begins", "ends"])


def read(documents: DataFrame) -> DataFrame:
    """doc_id, host, address, n, kinds, segs, edges, apart of each text that isn't blank, written once: all that follows reads this.

    segs are the 64-bit hashes of the segments: they only serve statistics and lookups, where one of a billion ordinary
    segments meets one of ten thousand responses by chance once in two million corpora.
    """
    if "source" not in documents.columns:
        documents = documents.withColumn("source", F.lit(None).cast("string"))
    clues = F.filter(F.split(F.lower(F.concat_ws(" ", "source_key", "section_name", "title")), r"[^\p{L}\p{M}\p{N}]+"), lambda w: F.length(w) > 3)
    parted = documents.where("trim(text) <> ''").select(
        "doc_id", F.coalesce("source", F.lit("")).alias("host"), F.xxhash64("title", "source_key").alias("address"), F.length("text").alias("n"),
        (~F.exists(clues, lambda w: F.contains(F.lower("text"), w))).alias("apart"), look.asNondeterministic()(F.col("text")).alias("_e"),
    )
    hashed = lambda texts: F.transform(F.array_remove(F.array_distinct(texts), ""), lambda s: F.xxhash64(s))
    edges = F.array_except(F.concat("_e.begins", "_e.ends"), F.col("_e.segs"))
    return materialise(parted.select("doc_id", "host", "address", "n", "apart", "_e.kinds", hashed(F.col("_e.segs")).alias("segs"), hashed(edges).alias("edges")))


# ---- evidence across texts --------------------------------------------------------------------------------------------

#: Characters' worth of texts by which a host's share of low information leans on the corpus's.
PRIOR = 100_000


def low_information(seen: DataFrame, brevity: float = 0.5) -> DataFrame:
    """seen with low: whether a body is shorter than `brevity` of the median of its host or the corpus, whichever is longer, or repeated at different addresses; n is at most the corpus's median, so no long text outweighs others."""
    whole = seen.agg(F.percentile_approx("n", 0.5).alias("_all"))
    hosts = seen.groupBy("host").agg(F.percentile_approx("n", 0.5).alias("_host"))
    bodies = seen.where("size(segs) > 0").select(F.xxhash64("segs").alias("_body"), "address").distinct().groupBy("_body").agg(F.count("*").alias("_places")).where("_places > 1")
    joined = seen.withColumn("_body", F.xxhash64("segs")).join(hosts, "host").join(bodies, "_body", "left").crossJoin(F.broadcast(whole))  # one row
    return joined.withColumn("low", (F.col("n") < brevity * F.greatest("_host", "_all")) | F.col("_places").isNotNull()).withColumn("n", F.least("n", "_all")).drop("_body", "_host", "_all", "_places")


def responses(seen: DataFrame, expected: float = 0.5) -> DataFrame:
    """seg of the segments served in place of content; `expected` is the share of a response's addresses with nothing else to say."""
    judged = materialise(low_information(seen).select("host", "address", "n", "segs", "apart", "low"))
    hosts = judged.groupBy("host").agg(F.sum(F.when(F.col("low"), F.col("n")).otherwise(0)).alias("low_n"), F.sum("n").alias("all_n"))
    base = hosts.agg((F.sum("low_n") / F.sum("all_n")).alias("base"))
    share = F.least(F.lit(expected), F.greatest(F.lit(1e-6), (F.col("low_n") + PRIOR * F.col("base")) / (F.col("all_n") + PRIOR)))
    rates = hosts.crossJoin(F.broadcast(base)).select("host", share.alias("rate"))  # one row
    # what bodies of low information repeat at different addresses; only these segments are counted in all others
    low = judged.where("low").select("address", "apart", F.explode("segs").alias("seg"))
    repeated = materialise(
        low.groupBy("seg", "address").agg(F.count("*").alias("c"), F.count_if("apart").alias("a")).groupBy("seg").agg(F.count("*").alias("places"), F.sum("c").alias("copies"), F.sum("a").alias("apart"), F.max("c").alias("most"))
        .where("places > 1 and 2 * apart >= copies and 2 * most <= copies").select("seg")
    )
    places = judged.select("host", "address", "low", F.explode("segs").alias("seg")).join(repeated, "seg", "left_semi").groupBy("seg", "host", "address").agg(F.max("low").alias("low"))
    gain = F.when(F.col("low"), F.log(F.lit(expected) / F.col("rate"))).otherwise(F.log((1 - F.lit(expected)) / (1 - F.col("rate"))))
    weighed = places.groupBy("seg", "host", "low").agg(F.count("*").alias("c")).join(rates, "host").groupBy("seg").agg(F.sum(F.col("c") * gain).alias("gain"))
    compared = low.agg(F.log(F.greatest(F.approx_count_distinct("seg"), F.lit(1))).alias("bar"))
    return weighed.crossJoin(F.broadcast(compared)).where("gain > bar").select("seg")  # one row


def flagged(documents: DataFrame) -> DataFrame:
    """doc_id, kinds of each document with residue; a response learned from the corpus has the kind ``served_response``."""
    seen = read(documents)
    learned = materialise(responses(seen))
    held = seen.select("doc_id", F.explode(F.concat("segs", "edges")).alias("seg")).join(learned, "seg", "left_semi").select("doc_id").distinct().withColumn("_served", F.lit(True))
    kinds = F.when(F.col("_served"), F.array_append("kinds", F.lit("served_response"))).otherwise(F.col("kinds"))
    return seen.join(held, "doc_id", "left").select("doc_id", kinds.alias("kinds")).where(F.size("kinds") > 0)
