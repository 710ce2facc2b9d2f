"""Mixing sources to target weights, by Pareto order sampling.

Sizes are tokens of a public tokenizer. Each listed source is given its share of the total, at most max_repeats times
its own size; what a source at its limit, or one without records, leaves over goes to the others in proportion to
their targets. A record's expected copies are the source's size factor times its relative weight. The whole copies
are certain; for the rest, the inclusion probability p, records are ranked by random odds divided by inclusion odds,
u/(1-u) : p/(1-p), and the first are taken until the source's tokens come nearest to what it is given, so each
source misses its size by no more than half a record.

The cut in that ranking is found without sorting a source: histograms over the rank value, cumulated per source,
narrow it in two rounds to one of 2^24 intervals, and only records in that interval are ordered.

Random numbers are hashes of (seed, id), the same at every run. Null sources and sources not in the targets have no
share and aren't taken. Records without tokens (null, empty texts) have no size and aren't taken. Targets without
records are reported with a share of 0. Shares needn't sum to 1; a null or negative share counts as 0, a null limit as 1.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise, small
from .bpe import count_column

BINS = 4096


def allocate(sizes: Mapping[str, float], targets: Mapping[str, tuple[float, int]], total: float | str | None = None) -> dict[str, float]:
    """Size given to each source. total: a size, None for that of all listed sources, "exact" for the largest at which every source with records gets its share."""
    limit = {s: sizes.get(s, 0) * max(0, repeats) for s, (_, repeats) in targets.items()}
    active = {s for s, (share, _) in targets.items() if share > 0 and limit[s] > 0}
    given = dict.fromkeys(targets, 0.0)
    if not active:
        return given
    if total == "exact":
        shares = sum(targets[s][0] for s in active)
        total = min(limit[s] * shares / targets[s][0] for s in active)
    elif total is None:
        total = sum(sizes.get(s, 0) for s in targets)
    rest = float(total)
    while active:
        shares = sum(targets[s][0] for s in active)
        full = {s for s in active if rest * targets[s][0] / shares >= limit[s]}
        if not full:
            for s in active:
                given[s] = rest * targets[s][0] / shares
            break
        for s in full:
            given[s] = float(limit[s])
        rest -= sum(limit[s] for s in full)
        active -= full
    return given


def uniform(seed: int, *key: Column) -> Column:
    """A number in (0, 1) from a hash."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *key), 11)
    return (bits.cast("double") + 0.5) / F.lit(float(2**53))


def sized(documents: DataFrame, id_column: str = "doc_id", text: str = "text", source: str = "source", weight: Column | None = None, vocabulary: str = "byte_bpe_50k") -> DataFrame:
    """id, source, n_tokens, weight of each record, written once to the shared folder."""
    w = F.greatest(F.coalesce(weight.cast("double"), F.lit(0.0)), F.lit(0.0)) if weight is not None else F.lit(1.0)
    return materialise(documents.select(F.col(id_column).alias("id"), F.col(source).alias("source"), count_column(F.col(text), vocabulary).alias("n_tokens"), w.alias("weight")))


class Mixture:
    """A mixture of one table of sizes."""

    def __init__(self, sizes: DataFrame, targets: DataFrame, total: float | str | None = None, seed: int = 20, most_sources: int = 10_000):
        spark = sizes.sparkSession
        rows = small(targets.select("source", "target_share", "max_repeats").where("source is not null"), most_sources, "targets")
        self.targets = {r.source: (max(0.0, float(r.target_share or 0)), int(1 if r.max_repeats is None else r.max_repeats)) for r in rows}
        names = spark.createDataFrame([(s,) for s in self.targets], "source string")
        held = sizes.where("n_tokens > 0").join(F.broadcast(names), "source")
        found = held.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.sum(F.col("n_tokens") * F.col("weight")).alias("weighted"), F.count("*").alias("records")).collect()  # at most a row per target
        self.found = {r.source: r for r in found}
        self.given = allocate({s: r.tokens for s, r in self.found.items()}, self.targets, total)
        rates = spark.createDataFrame([(s, self.given[s] / r.weighted if r.weighted else 0.0, float(self.targets[s][1])) for s, r in self.found.items()], "source string, rate double, most double")
        expected = F.least(F.col("rate") * F.col("weight"), F.col("most"))
        whole = F.floor(expected + 1e-9)
        p = F.greatest(F.lit(0.0), expected - whole)
        u = uniform(seed, F.col("id"), F.col("n_tokens"))
        odds = (u / (1 - u)) / (p / (1 - p))
        # odds/(1+odds) keeps the order of the odds and lies in (0, 1); records without a fractional copy rank last
        self.ranked = held.join(F.broadcast(rates), "source").select("id", "source", "n_tokens", whole.cast("int").alias("whole"), F.when((p > 1e-12) & (whole < F.col("most")), odds / (1 + odds)).alias("rank"))
        self.chosen = self._choose()

    def _cut(self, rest: DataFrame, bounds: DataFrame) -> DataFrame:
        """bounds (source, low, width, left) narrowed to one of BINS bins: the bin where the cumulated tokens pass `left`."""
        within = rest.join(F.broadcast(bounds), "source").where("rank >= low and rank < low + width")
        bin_ = F.least(F.floor((F.col("rank") - F.col("low")) / F.col("width") * BINS), F.lit(BINS - 1)).cast("int")
        counted = within.groupBy("source", "low", "width", "left", bin_.alias("bin")).agg(F.sum("n_tokens").alias("n"))
        w = "sum(n) over (partition by source order by bin)"
        cumulated = counted.withColumn("_before", F.expr(w) - F.col("n"))
        passed = cumulated.where("_before + n >= left").groupBy("source").agg(F.min_by(F.struct(F.col("low") + F.col("width") * F.col("bin") / BINS, F.col("width") / BINS, F.col("left") - F.col("_before")), "bin").alias("b"))
        return passed.select("source", F.col("b.col1").alias("low"), F.col("b.col2").alias("width"), F.col("b.col3").alias("left"))

    def _choose(self) -> DataFrame:
        spark = self.ranked.sparkSession
        ranked = materialise(self.ranked)
        certain = {r[0]: r[1] for r in ranked.groupBy("source").agg(F.sum(F.col("whole") * F.col("n_tokens"))).collect()}  # at most a row per target
        schema = "source string, low double, width double, left double"
        bounds = spark.createDataFrame([(s, 0.0, 1.0, float(self.given[s] - certain.get(s, 0))) for s in self.found], schema)
        rest = ranked.where("rank is not null").select("source", "rank", "n_tokens")
        for _ in range(2):
            bounds = spark.createDataFrame(self._cut(rest, bounds).collect(), schema)  # at most a row per target
        # sources whose fractional copies all fit have no cut left: everything below 1 is taken
        cut = {r.source: r for r in bounds.collect()}
        full = [(s, cut[s].low if s in cut else 2.0, cut[s].width if s in cut else 0.0, cut[s].left if s in cut else 0.0) for s in self.found]
        placed = ranked.join(F.broadcast(spark.createDataFrame(full, schema)), "source")
        at_cut = "rank is not null and rank >= low and rank < low + width"
        clear = placed.where(f"not coalesce({at_cut}, false)").withColumn("extra", F.coalesce(F.col("rank") < F.col("low"), F.lit(False)).cast("int"))
        order = "partition by source order by rank, id, n_tokens rows between unbounded preceding and current row"
        edge = placed.where(at_cut).withColumn("_c", F.expr(f"sum(n_tokens) over ({order})")).withColumn("extra", (F.col("_c") - F.col("n_tokens") / 2 <= F.col("left")).cast("int")).drop("_c")
        return clear.unionByName(edge).select("id", "source", "n_tokens", (F.col("whole") + F.col("extra")).alias("copies")).where("copies > 0")

    def shares(self) -> DataFrame:
        """One row per target: what was asked, given and reached."""
        spark = self.ranked.sparkSession
        rows = [(s, share, repeats, int(self.found[s].records) if s in self.found else 0, int(self.found[s].tokens) if s in self.found else 0, float(self.given[s])) for s, (share, repeats) in self.targets.items()]
        asked = spark.createDataFrame(rows, "source string, target_share double, max_repeats int, records long, tokens long, given_tokens double")
        got = self.chosen.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("reached_tokens"), F.sum("copies").alias("copies"), F.max("copies").alias("most_copies"))
        total = got.agg(F.sum("reached_tokens").alias("_total"))
        joined = asked.join(got, "source", "left").crossJoin(F.broadcast(total))  # one row
        zero = lambda c: F.coalesce(F.col(c), F.lit(0))
        return joined.select(
            "source", "target_share", "max_repeats", "records", "tokens", "given_tokens", zero("reached_tokens").cast("long").alias("reached_tokens"),
            zero("copies").cast("long").alias("copies"), zero("most_copies").cast("int").alias("most_copies"),
            F.coalesce(F.try_divide(F.col("reached_tokens").cast("double"), F.col("_total").cast("double")), F.lit(0.0)).alias("reached_share"),
        )


def expand(documents: DataFrame, chosen: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Each chosen record as often as it was chosen, with copy numbers from 1."""
    picked = chosen.select(F.col("id").alias(id_column), "copies")
    return documents.join(picked, id_column).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("copies")
