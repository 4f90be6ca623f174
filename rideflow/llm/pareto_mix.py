"""Mix of sources by Pareto order sampling.

A document whose expected number of copies is e gets floor(e) copies for certain and one more with probability p, the rest. Which
documents get that one more is decided by rank: U / (1 - U) divided by p / (1 - p), with U uniform and fixed by the document and the seed;
the documents of smallest rank are taken until the source has its words. That gives samples of fixed size with
inclusion probabilities close to p.

Where the ranks of a source are cut is found without sorting them: words are summed by the leading bits of the rank, the
slice that crosses the target is opened again by its next bits, and so on. A document that would overshoot is passed over, and the search goes
on behind it among those that still fit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rideflow.sources.workdir import materialize, work_dir

WORD = r"[^\x20\x09-\x0D]+"
LEVEL_BITS = 16
LEVELS = 3
RANK_BITS = LEVEL_BITS * LEVELS
RUNS = "array<struct<low:bigint,high:bigint,most:bigint>>"
NEAR = 0.001


def n_words(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fill_shares(items: DataFrame, total: float) -> DataFrame:
    """`items` with `target` = min(cap, rate * weight), where the rate makes the targets add up to `total` (or to all caps, if those are less).

    What an item cannot take goes to the others by weight. Each step is one sum over the items, of which one row comes to the driver; the
    rate only rises, until no further item is full.
    """
    rate, known = 0.0, None
    while True:
        full = F.col("weight") * rate >= F.col("cap")
        done = items.agg(F.sum(F.when(full, F.col("cap"))), F.sum(F.when(full, 0.0).otherwise(F.col("weight"))), F.sum(full.cast("int"))).first()
        if not done[1] or done[2] == known and known is not None:
            break
        known, rate = done[2], (total - (done[0] or 0.0)) / done[1]
    return items.withColumn("target", F.when(full, F.col("cap").cast("double")).otherwise(F.col("weight") * rate))


def _uniform(seed: int, *columns: str) -> Column:
    """A number strictly between 0 and 1, fixed by the columns."""
    return (F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 12) + 0.5) / float(1 << 52)


def with_copies(docs: DataFrame, cuts: DataFrame, max_copies: int = 2, weight: str | None = None, seed: int = 1) -> DataFrame:
    """`docs` (doc_id, source, size and any other columns) with `copies` under `cuts` (source, rate, runs). The join is on the source
    alone, whose cuts are one row, so a source with very many rows can be split."""
    found = _ranked(docs, cuts.select(F.col("source").alias("_source"), "rate", "runs"), max_copies, weight, seed)
    fits = lambda r: (F.col("_rank") >= r.low) & (F.col("_rank") < r.high) & (F.col("size") <= F.coalesce(r.most, F.col("size")))
    chosen = (F.col("size") > 0) & F.exists("runs", fits)
    copies = F.col("_whole") + F.coalesce(chosen.cast("int"), F.lit(0))
    return found.withColumn("copies", copies).select(*[docs[c] for c in docs.columns], "copies")


def _ranked(docs: DataFrame, rates: DataFrame, max_copies: int, weight: str | None, seed: int) -> DataFrame:
    """`docs` joined with `rates` (_source, rate, ...), with the certain copies `_whole` and the rank for one more, `_rank`."""
    w = F.coalesce(F.col(weight).cast("double"), F.lit(0.0)) if weight else F.lit(1.0)
    expected = F.least(F.lit(float(max_copies)), F.coalesce("rate", F.lit(0.0)) * w)
    u = _uniform(seed, "doc_id", "size")
    part = F.col("_expected") - F.col("_whole")
    odds = (u / (1 - u)) / (part / (1 - part))
    # odds / (1 + odds) has the order of the odds and lies between 0 and 1
    rank = F.when(part > 0, F.least(F.lit((1 << RANK_BITS) - 1), F.floor(odds / (1 + odds) * float(1 << RANK_BITS))))
    return (docs.join(rates, docs["source"].eqNullSafe(rates["_source"]), "left").withColumn("_expected", expected)
            .withColumn("_whole", F.floor("_expected")).withColumn("_rank", rank))


def pareto_cuts(docs: DataFrame, targets: DataFrame, max_copies: int = 2, weight: str | None = None, seed: int = 1) -> DataFrame:
    """source, rate, runs: expected copies of a document of weight 1, and the ranges of ranks that get one more copy."""
    spark = docs.sparkSession
    goals = materialize(targets.select("source", "source_size", "target"), work_dir(spark))
    slim = docs.select("doc_id", "source", "size", *([F.coalesce(F.col(weight).cast("double"), F.lit(0.0)).alias("w")] if weight else []))
    rates = _rates(slim, goals, max_copies) if weight else goals.select("source", F.try_divide("target", "source_size").alias("rate"))
    ranked = _ranked(slim, rates.select(F.col("source").alias("_source"), "rate"), max_copies, "w" if weight else None, seed)
    rows = materialize(ranked.select(slim["source"], "size", F.col("_whole").alias("whole"), F.col("_rank").alias("rank")), work_dir(spark))
    certain = rows.groupBy("source").agg(F.sum(F.col("whole") * F.col("size")).alias("sure"))
    rest = (goals.alias("g").join(certain.alias("c"), _same("g", "c"))
            .select("g.source", "target", F.greatest(F.lit(0.0), F.col("target") - F.col("sure")).alias("gap"), F.lit(0).cast("long").alias("low"),
                    F.lit(None).cast("long").alias("most"), F.array().cast(RUNS).alias("runs")))
    rest = materialize(_one_pass(rows, materialize(rest, work_dir(spark))), work_dir(spark))
    # a pass takes what fits and ends at a document larger than what is left, so that the gap shrinks with every pass
    still = F.coalesce((F.col("gap") > F.col("target") * NEAR) & (F.col("gap") >= 1) & F.col("more"), F.lit(False))
    while not rest.where(still).isEmpty():
        again = _one_pass(rows, materialize(rest.where(still), work_dir(spark)))
        rest = materialize(again.unionByName(rest.where(~still)), work_dir(spark))
    return materialize(rest.alias("r").join(rates.alias("g"), _same("r", "g")).select("r.source", "rate", "runs"), work_dir(spark))


def pareto_mix(docs: DataFrame, targets: DataFrame, max_copies: int = 2, weight: str | None = None, seed: int = 1) -> DataFrame:
    """`docs` (doc_id, source, size: not null, and any other columns) with `copies`, for `targets` (source, source_size, target).

    A source's copies have `target` words up to a share of NEAR, or fewer where no further document fits, never more unless equal ranks meet; nulls in source match the null source, a source without
    a target gets no copies. Within a source expected copies are equal, or follow the column `weight` (not negative, null counts as 0) up
    to `max_copies`, the excess going to the others. Documents without words get the certain copies only. Rows with equal doc_id, source and
    size are taken or left together. The result does not depend on the order of rows or on partitions. An empty table gives no rows.
    """
    return with_copies(docs, pareto_cuts(docs, targets, max_copies, weight, seed), max_copies, weight, seed)


def _one_pass(rows: DataFrame, rest: DataFrame) -> DataFrame:
    """Cut the ranks of each source where the next document would exceed its gap.

    rest: source, target, gap (words to take), low (ranks from here on), most (largest size that fits), runs (ranks taken so far).
    """
    spark = rows.sparkSession
    bits = RANK_BITS
    state = rest.select("source", "low", "most", "gap", F.lit(0).cast("long").alias("prefix"), F.col("gap").alias("left"), F.lit(True).alias("more"))
    for level in range(LEVELS):
        shift = bits - LEVEL_BITS * (level + 1)
        slices = (rows.alias("d").join(state.alias("t"), _same("d", "t"))
                  .where((F.col("rank") >= F.col("low")) & (F.col("size") <= F.coalesce("most", "size")) & (F.col("size") > 0)
                         & (F.shiftright("rank", shift + LEVEL_BITS) == F.col("prefix")))
                  .groupBy("d.source", F.shiftright("rank", shift).alias("slice")).agg(F.sum("size").alias("words")))
        upto = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, 0)
        summed = slices.withColumn("upto", F.sum("words").over(upto))
        # the first slice that does not fit; if all fit, the end
        crossed = (summed.alias("s").join(state.alias("t"), _same("s", "t"))
                   .groupBy("s.source").agg(F.min(F.when(F.col("upto") > F.col("left"), F.struct("slice", (F.col("upto") - F.col("words")).alias("under")))).alias("hit"),
                                            F.max("upto").alias("all")))
        state = (state.alias("t").join(crossed.alias("c"), _same("t", "c"), "left")
                 .select("t.source", "low", "most", "gap",
                         F.coalesce("hit.slice", F.lit(1 << (bits - shift))).cast("long").alias("prefix"),
                         (F.col("left") - F.coalesce("hit.under", "all", F.lit(0))).alias("left"),
                         F.col("hit").isNotNull().alias("more")))
        # once all of it fits, no slice has the prefix of the end, and the levels below leave it as it is
        state = materialize(state, work_dir(spark))
    high = F.when(F.col("t.more"), F.col("t.prefix")).otherwise(F.lit(1 << bits))
    run = F.struct(F.col("r.low").alias("low"), high.cast("long").alias("high"), F.col("r.most").alias("most"))
    return (rest.alias("r").join(state.alias("t"), _same("r", "t"))
            .select("r.source", "target", F.col("t.left").alias("gap"), (high + 1).cast("long").alias("low"), F.floor("t.left").alias("most"),
                    F.concat("runs", F.array(run)).alias("runs"), "t.more"))



def _same(x: str, y: str) -> Column:
    return F.col(f"{x}.source").eqNullSafe(F.col(f"{y}.source"))


def _rates(rows: DataFrame, goals: DataFrame, max_copies: int) -> DataFrame:
    """source, rate: expected copies are least(max_copies, rate * w), so that their words add up to the source's target."""
    spark = rows.sparkSession
    rates, known = goals.select("source", "target", F.lit(0.0).alias("rate")), None
    while True:
        full = F.col("w") * F.col("rate") >= max_copies
        words = F.col("size").cast("double")
        sums = (rows.alias("d").join(rates.alias("g"), _same("d", "g")).groupBy("g.source", "target", "rate")
                .agg(F.sum(F.when(full, words * max_copies).otherwise(0.0)).alias("held"),
                     F.sum(F.when(full, 0.0).otherwise(words * F.col("w"))).alias("free"), F.sum(full.cast("int")).alias("n")))
        rise = F.when(F.col("free") > 0, (F.col("target") - F.col("held")) / F.col("free")).otherwise(F.col("rate"))
        sums = materialize(sums.select("source", "target", F.greatest("rate", rise).alias("rate"), "n"), work_dir(spark))
        n = sums.agg(F.sum("n")).first()[0]
        if n == known or n is None:
            return sums.select("source", "rate")
        rates, known = sums.select("source", "target", "rate"), n
