"""Schemas that drift between files: a catalogue of column lifespans.

Each file is first reduced to its footer, the paths it holds with the number of stated values of each class; one
pass over the values with map-side aggregation, and all that follows but the comparison of renamed columns works on
footers. Editions of a data set are numbered in order; ``lag`` over the numbers finds the islands, the unbroken runs
of files that hold a path (or a path with one class). An island that doesn't begin with the first file is a start, one
that ends before the last an ending. A start and an ending of the same path's classes at one file is a changed type.
Starts and endings of paths at one file whose values agree are renames; they make the alias table, from which the
casts of the consistent table come.

Defined results: a null path component reads as empty; null, blank and absence texts aren't stated, so they neither
have a class nor count for a rename; a path without stated values has no class; equal class counts give the class
named first in CLASSES. Rows staged twice count once. A data set with one file has no changes. Files without data set or
edition belong to none and are left out; other columns, whatever their names, are never read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise

#: Statements that a value is absent, lower case (fixed values).
ABSENCES = ("na", "n/a", "n.a.", "negl", "-", "none reported", "not available", "unknown")
#: Changed paths that go to every executor instead of all values to the changed paths: about 100 bytes each.
BROADCAST_PATHS = 200_000
CLASSES = ("whole", "decimal", "percentage", "date", "text")

_MONTH = "(?:jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)\\.?"
_DIGITS = "(?:\\d{1,3}(?:[, \\u00a0']\\d{3})+|\\d+)"
_DATE = f"(?i)(?:\\d{{4}}-\\d{{2}}-\\d{{2}}|\\d{{1,2}}\\.? {_MONTH},? \\d{{4}}|{_MONTH} \\d{{1,2}},? \\d{{4}}|\\d{{1,2}}[/.]\\d{{1,2}}[/.]\\d{{4}})"
_NOTES = "(?:\\s*(?:\\([^()]*\\)|\\[[^\\[\\]]*\\]))+\\s*$"


def stated(text: Column) -> Column:
    """Whether a text states a value."""
    t = F.lower(F.trim(text))
    return text.isNotNull() & (t != "") & ~t.isin(*ABSENCES)


def bare(text: Column) -> Column:
    """A text without blanks around it and notes in brackets at its end."""
    return F.trim(F.when(text.rlike("[)\\]]\\s*$"), F.regexp_replace(text, _NOTES, "")).otherwise(text))


def kind_of(text: Column) -> Column:
    """The class of a stated value; text must be bare."""
    whole = text.rlike(f"^[-−+]?{_DIGITS}$")
    return (
        F.when(~text.rlike("\\d"), "text")
        .when(whole, "whole")
        .when(text.rlike(f"^[-−+]?(?:{_DIGITS})?\\.\\d+$"), "decimal")
        .when(text.rlike(f"(?i)^[-−+]?{_DIGITS}?(?:\\.\\d+)?\\s*(?:%|percent|per cent)$"), "percentage")
        .when(text.rlike(f"^{_DATE}$"), "date")
        .otherwise("text")
    )


def day_of(text: Column) -> Column:
    """The date of a bare text of the class date. 5.3.2020 has the day first, 5/3/2020 the month, unless that is beyond 12."""
    words = F.initcap(F.regexp_replace(F.regexp_replace(text, "[.,]", ""), "(?i)\\bsept\\b", "Sep"))
    named = (F.try_to_timestamp(words, F.lit(f)) for f in ("d MMMM yyyy", "d MMM yyyy", "MMMM d yyyy", "MMM d yyyy"))
    plain = (F.try_to_timestamp(text, F.lit(f)) for f in ("yyyy-MM-dd", "d.M.yyyy", "M/d/yyyy", "d/M/yyyy"))
    return F.coalesce(*plain, *named).cast("date")


def path_of(*parts: Column) -> Column:
    """The components of a path joined by |, null as empty."""
    return F.concat_ws("|", *(F.coalesce(p, F.lit("")) for p in parts))


def staged_values(raw_field: DataFrame, artifact: DataFrame) -> DataFrame:
    """dataset_code, edition_year, source_key, path, raw_text of the edition files, with record_id and ordinal where there are any, rows staged twice included."""
    files = artifact.where("parser_family <> 'delimited_export' or parser_family is null").where("dataset_code is not null and edition_year is not null").select("artifact_id", "dataset_code", "edition_year").distinct()
    values = raw_field.select("artifact_id", "source_key", path_of(F.col("section_name"), F.col("field_name"), F.col("subfield_name")).alias("path"), "raw_text", *(c for c in ("record_id", "ordinal") if c in raw_field.columns))
    return values.join(files, "artifact_id").drop("artifact_id")


def footers(values: DataFrame) -> DataFrame:
    """dataset_code, edition_year, path, kind: one row per path of a file, with the class of most stated values."""
    kind = F.when(stated(F.col("raw_text")), kind_of(bare(F.col("raw_text"))))
    counted = values.select("dataset_code", "edition_year", "path", kind.alias("k")).groupBy("dataset_code", "edition_year", "path").agg(*[F.count_if(F.col("k") == c).alias(c) for c in CLASSES])
    most = F.greatest(*CLASSES)
    return counted.select("dataset_code", "edition_year", "path", F.when(most > 0, reduce(lambda w, c: w.when(F.col(c) == most, c), CLASSES[1:], F.when(F.col(CLASSES[0]) == most, CLASSES[0]))).alias("kind"))


def numbered(footer: DataFrame) -> DataFrame:
    """Footers with nth, the number of the edition within its data set, and last, the number of editions."""
    editions = footer.select("dataset_code", "edition_year").distinct()
    w = Window.partitionBy("dataset_code")
    editions = editions.select("*", F.row_number().over(w.orderBy("edition_year")).alias("nth"), F.count("*").over(w).alias("last"))
    return footer.join(editions, ["dataset_code", "edition_year"])


def lifespans(footer: DataFrame, by: list[str]) -> DataFrame:
    """The islands of `by`: first and last edition number of each unbroken run."""
    w = Window.partitionBy(*by).orderBy("nth")
    marked = footer.select(*by, "nth", "last", F.when(F.coalesce(F.lag("nth").over(w), F.lit(-1)) != F.col("nth") - 1, 1).otherwise(0).alias("_new"))
    runs = marked.withColumn("island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy(*by, "island").agg(F.min("nth").alias("first"), F.max("nth").alias("until"), F.max("last").alias("last"))


class Drift:
    """The catalogue of one table of values; footers and the values of changed paths are written once and reused."""

    def __init__(self, values: DataFrame):
        self.values = values
        self.footer = materialise(numbered(footers(values)))
        self.paths = materialise(lifespans(self.footer, ["dataset_code", "path"]))
        self.kinds = materialise(lifespans(self.footer.where("kind is not null"), ["dataset_code", "path", "kind"]))
        self.starts = self.paths.where("first > 1").select("dataset_code", F.col("first").alias("nth"), F.col("path").alias("new_path"))
        self.ends = self.paths.where("until < last").select("dataset_code", (F.col("until") + 1).alias("nth"), F.col("path").alias("old_path"))
        self._renames: DataFrame | None = None

    def renames(self) -> DataFrame:
        """dataset_code, nth, old_path, new_path, same, both: pairs of an ending and a start at one file that agree.

        Pairs come from equality of (file, source key, text), so only pairs with some agreement are looked at; their
        common source keys are then counted by path. Rows never meet all others of their file.
        """
        if self._renames is not None:
            return self._renames
        years = self.footer.select("dataset_code", "nth", "edition_year").distinct()
        sides = self.ends.select("dataset_code", "nth", F.col("old_path").alias("path"), F.lit(0).alias("side"), (F.col("nth") - 1).alias("at")).unionByName(
            self.starts.select("dataset_code", "nth", F.col("new_path").alias("path"), F.lit(1).alias("side"), F.col("nth").alias("at"))
        )
        at = years.select("dataset_code", F.col("nth").alias("at"), "edition_year")
        changed = materialise(sides.join(at, ["dataset_code", "at"]).drop("at"))
        if changed.limit(BROADCAST_PATHS + 1).count() <= BROADCAST_PATHS:
            changed = F.broadcast(changed)  # else the values shuffle by path
        # equality of texts is all that counts here, so long ones travel as digests
        text = F.when(F.length("raw_text") > 40, F.sha2("raw_text", 256)).otherwise(F.col("raw_text"))
        held = materialise(
            self.values.where(stated(F.col("raw_text"))).withColumn("raw_text", text).join(changed, ["dataset_code", "edition_year", "path"])
            .select("dataset_code", "nth", "side", "path", "source_key", "raw_text").where("source_key is not null").distinct()
        )
        side = lambda n, name: held.where(F.col("side") == n).select("dataset_code", "nth", "source_key", "raw_text", F.col("path").alias(name))
        old, new = side(0, "old_path"), side(1, "new_path")
        pair = ["dataset_code", "nth", "old_path", "new_path"]
        same = old.join(new, ["dataset_code", "nth", "source_key", "raw_text"]).groupBy(*pair).agg(F.count_distinct("source_key").alias("same"))
        keys = lambda df, name: df.select("dataset_code", "nth", name, "source_key").distinct()
        both = (
            same.join(keys(old, "old_path"), ["dataset_code", "nth", "old_path"])
            .join(keys(new, "new_path"), ["dataset_code", "nth", "new_path", "source_key"])
            .groupBy(*pair, "same").agg(F.count("*").alias("both"))
        )
        self._renames = materialise(both.where("same * 2 > both"))
        return self._renames

    def changes(self) -> DataFrame:
        """dataset_code, edition_year, change_kind, old_path, new_path: the report of every change."""
        renames, none = self.renames(), F.lit("")
        renamed = renames.select("dataset_code", "nth", F.lit("renamed").alias("change_kind"), "old_path", "new_path")
        added = self.starts.join(renames, ["dataset_code", "nth", "new_path"], "left_anti").select("dataset_code", "nth", F.lit("added").alias("change_kind"), none.alias("old_path"), "new_path")
        removed = self.ends.join(renames, ["dataset_code", "nth", "old_path"], "left_anti").select("dataset_code", "nth", F.lit("removed").alias("change_kind"), "old_path", none.alias("new_path"))
        begun = self.kinds.where("first > 1").select("dataset_code", "path", F.col("first").alias("nth"))
        ended = self.kinds.where("until < last").select("dataset_code", "path", (F.col("until") + 1).alias("nth"))
        retyped = begun.join(ended, ["dataset_code", "path", "nth"]).select("dataset_code", "nth", F.lit("type_changed").alias("change_kind"), F.col("path").alias("old_path"), F.col("path").alias("new_path"))
        years = self.footer.select("dataset_code", "nth", "edition_year").distinct()
        every = reduce(DataFrame.unionByName, [renamed, added, removed, retyped])
        return every.join(years, ["dataset_code", "nth"]).select("dataset_code", "edition_year", "change_kind", "old_path", "new_path")

    def aliases(self) -> DataFrame:
        """dataset_code, path, first, until, canonical_path: each island with the last name of its chain of renames.

        Chains are followed by pointer doubling, so a chain over n files takes log2(n) rounds, each written to the
        shared folder. Where an ending has several renames the one with the greatest agreement, then the first name, counts.
        """
        best = Window.partitionBy("dataset_code", "nth", "old_path").orderBy(F.desc(F.col("same") / F.col("both")), F.desc("same"), "new_path")
        step = self.renames().withColumn("_r", F.row_number().over(best)).where("_r = 1").select("dataset_code", "nth", F.col("old_path").alias("path"), "new_path")
        islands = self.paths.select("dataset_code", "path", "first", "until")
        target = islands.select("dataset_code", F.col("path").alias("new_path"), F.col("first").alias("nth"), F.col("until").alias("to_until"))
        to = islands.withColumn("nth", F.col("until") + 1).join(step, ["dataset_code", "nth", "path"], "left").join(target, ["dataset_code", "nth", "new_path"], "left")
        chain = materialise(to.select("dataset_code", "path", "first", "until", F.coalesce("new_path", "path").alias("canonical_path"), F.coalesce("to_until", "until").alias("_end")))
        while True:
            nxt = chain.select("dataset_code", F.col("path").alias("canonical_path"), F.col("until").alias("_end"), F.col("canonical_path").alias("_p"), F.col("_end").alias("_e"))
            longer = materialise(
                chain.join(nxt, ["dataset_code", "canonical_path", "_end"], "left")
                .select("dataset_code", "path", "first", "until", F.coalesce("_p", "canonical_path").alias("canonical_path"), F.coalesce("_e", "_end").alias("_end"), (F.coalesce("_e", "_end") != F.col("_end")).alias("_moved"))
            )
            moved = longer.where("_moved").limit(1).count()
            chain = longer.drop("_moved")
            if not moved:
                return chain.drop("_end")

    def consistent(self, absences: bool = False) -> DataFrame:
        """Every stated value under its canonical path, cast to the one type that holds all classes the path ever had.

        With `absences`, rows that state none are kept, their value columns null. record_id and ordinal are carried.

        value_type: whole and decimal give decimal; percentages alone give percentage, dates alone date, a mixture text.
        value_number holds numbers and percentages (as percent), value_date dates, value_text every value.
        """
        aliases = self.aliases()
        named = self.footer.join(aliases, ["dataset_code", "path"]).where("nth between first and until")
        types = named.groupBy("dataset_code", "canonical_path").agg(F.array_sort(F.collect_set("kind")).alias("_k"))
        numbers = F.size(F.array_except("_k", F.array(F.lit("whole"), F.lit("decimal")))) == 0
        value_type = F.when(F.size("_k") == 0, "text").when(F.size("_k") == 1, F.col("_k")[0]).when(numbers, "decimal").otherwise("text")
        types = types.select("dataset_code", "canonical_path", value_type.alias("value_type"))
        fields = named.join(types, ["dataset_code", "canonical_path"]).select("dataset_code", "edition_year", "path", "canonical_path", "value_type")
        text = bare(F.col("value_text"))
        number = F.regexp_replace(F.regexp_replace(text, "[,  ']|(?i)\\s*(%|percent|per cent)$", ""), "−", "-").try_cast("decimal(38,10)")
        day = day_of(text)
        has = stated(F.col("raw_text"))
        rows = (self.values.withColumn("raw_text", F.when(has, F.col("raw_text"))) if absences else self.values.where(has)).distinct().withColumnRenamed("raw_text", "value_text").join(fields, ["dataset_code", "edition_year", "path"])
        kept = [c for c in ("record_id", "ordinal") if c in rows.columns]
        return rows.select(
            "dataset_code", "edition_year", "source_key", *kept, F.col("canonical_path").alias("path"), F.col("path").alias("source_path"), "value_type", "value_text",
            F.when(F.col("value_type").isin("whole", "decimal", "percentage"), number).alias("value_number"), F.when(F.col("value_type") == "date", day).alias("value_date"),
        )
