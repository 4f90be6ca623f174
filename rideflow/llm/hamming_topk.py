"""Exact nearest binary codes by incremental multi-index hashing.

A code is cut into m segments, and every segment has an index from its value to the codes that hold it. If two codes differ in d
bits, then for every r and s with d <= m * r + s, one of the first s + 1 segments differs in at most r bits or one of the others in
at most r - 1. So the search probes segment values at growing distance, one (radius, segment) step at a time, verifies what it meets by
its whole Hamming distance, and a query stops when its kth distance is within what the steps so far cover.

The number of segments is the one with the least estimated work: wide segments make many probes, each a row that is shuffled, narrow ones
many codes to compare in the join. A query starts from its kth distance to `SEEDS` codes, so that what is farther away is no row either.
Both decide on the work only: whatever they are, the answers are exact.

Codes are searched, not rows: equal codes are one entry with their k + 1 smallest ids, which is all a query can need of
them, and equal query codes search once.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rideflow.sources.workdir import materialize, work_dir

BITS = 64
JOINT = 600
SEEDS = 1024
PROBE = 64  # comparisons that take as long as one probe


def sign_code(vector: Column, bits: int = BITS) -> Column:
    """Bit i tells whether component i is above 0, as a long; null unless the vector has `bits` finite components."""
    plain = F.transform(vector, lambda x: x.cast("double"))
    fine = (F.size(plain) == bits) & F.forall(plain, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    as_text = F.array_join(F.reverse(F.transform(plain, lambda x: F.when(x > 0, F.lit("1")).otherwise(F.lit("0")))), "")
    high, low = F.conv(as_text.substr(1, bits - 32), 2, 10).cast("long"), F.conv(as_text.substr(bits - 31, 32), 2, 10).cast("long")
    return F.when(fine, F.shiftleft(high, 32).bitwiseOR(low))


def _radius(n_codes: int, k: int, bits: int) -> int:
    """The distance within which k of so many evenly spread codes are expected."""
    within = 0
    for distance in range(bits):
        within += comb(bits, distance)
        if n_codes * within >= k << bits:
            return distance
    return bits


def _cuts(m: int, bits: int) -> list[tuple[int, int]]:
    cuts = [bits * i // m for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def estimated_work(plan: list[tuple[int, int]], n_codes: int, k: int, bits: int = BITS) -> tuple[int, float]:
    """Probes and comparisons of one query until it has covered the distance of its kth code."""
    distance, m = _radius(n_codes, k, bits), len(plan)
    probes = [sum(comb(w, r) for r in range((distance - s) // m + 1)) for s, (_, w) in enumerate(plan)]
    return sum(probes), sum(p * n_codes / (1 << w) for p, (_, w) in zip(probes, plan))


def segment_plan(n_codes: int, bits: int = BITS, k: int = 10) -> list[tuple[int, int]]:
    """(first bit, width) of the segments for the least estimated work. They have 8 bits or more, in small tables 4, as narrower
    ones compare most codes several times."""
    narrowest = 8 if n_codes >= 256 else 4

    def work(plan: list[tuple[int, int]]) -> float:
        probes, compared = estimated_work(plan, n_codes, k, bits)
        return PROBE * probes + compared

    return min((_cuts(m, bits) for m in range(1, max(1, bits // narrowest) + 1)), key=work)


def _masks(width: int, radius: int) -> Column:
    """All segment values with `radius` bits set, as one constant."""
    found = ",".join(str(sum(1 << i for i in bits)) for bits in combinations(range(width), radius))
    return F.split(F.lit(found), ",").cast("array<int>")


def _steps(plan: list[tuple[int, int]]) -> list[tuple[int, list[int]]]:
    """(radius, segments): all segments of a radius together while they have few values, else one at a time."""
    steps = []
    for radius in range(max(w for _, w in plan) + 1):
        segments = [s for s, (_, w) in enumerate(plan) if radius <= w]
        joint = comb(plan[0][1], radius) * len(segments) <= JOINT
        steps += [(radius, segments)] if joint else [(radius, [s]) for s in segments]
    return steps


def hamming_topk(codes: DataFrame, queries: DataFrame, k: int = 10, bits: int = BITS) -> DataFrame:
    """query_id, rank, id, distance: the k nearest codes of each row of `queries` among all rows of `codes`.

    Both have (id long, code long); a null code takes no part, a null id neither. A row with the query's own id is no answer. Ties go to
    the smaller id; rows with equal id and code are one; an id with several codes counts with its nearest. Fewer than k
    others give fewer rows; an empty table gives none. Exact at every size: no bound on candidates or radius.
    """
    spark = codes.sparkSession
    rows = codes.where("id IS NOT NULL AND code IS NOT NULL").select("id", "code").distinct()
    asked = materialize(queries.where("id IS NOT NULL AND code IS NOT NULL").select("id", "code").distinct(), work_dir(spark))
    first = Window.partitionBy("code").orderBy("id")
    entries = rows.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= k + 1)
    index = materialize(entries.groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids")), work_dir(spark))
    plan = segment_plan(index.count(), bits, _room(k))
    m = len(plan)
    seeds = {r.id: r.code for r in index.orderBy(F.xxhash64("code")).limit(SEEDS).select(F.col("ids")[0].alias("id"), "code").collect()}

    def values(code: Column, segments: list[int]) -> Column:
        return F.explode(F.array(*[
            F.struct(F.lit(s).alias("segment"), F.lit(1 << plan[s][1]).alias("room"),
                     F.shiftrightunsigned(code, plan[s][0]).bitwiseAND(F.lit((1 << plan[s][1]) - 1)).cast("int").alias("value"))
            for s in segments])).alias("at")

    held = index.select("code", "ids", values(F.col("code"), list(range(m)))).select("code", "ids", "at.segment", "at.value")
    held = materialize(held, work_dir(spark))

    # answers: up to k + 1 nearest ids met so far; the own id may be one of them
    active = asked.select("code").distinct().withColumnRenamed("code", "q").withColumn("bound", _least_bound(F.col("q"), list(seeds.values()), _room(k), bits))
    active = materialize(active, work_dir(spark))
    answers = spark.createDataFrame([], "q long, id long, distance int")
    for radius, segments in _steps(plan):
        widest = max(plan[s][1] for s in segments)
        # a few queries make very many probes: deal them out first
        dealt = active.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "q")
        probes = (dealt.select("q", "bound", values(F.col("q"), segments))
                  .select("q", "bound", "at", F.explode(_masks(widest, radius)).alias("mask")).where("mask < at.room")
                  .select("q", "bound", "at.segment", F.col("at.value").bitwiseXOR(F.col("mask")).alias("value")))
        hits = (probes.join(held.where(F.col("segment").isin(segments)).hint("shuffle_hash"), ["segment", "value"])
                .withColumn("distance", F.bit_count(F.col("q").bitwiseXOR(F.col("code"))))
                .where("distance <= bound").select("q", "distance", "code", "ids"))
        hits = hits.dropDuplicates(["q", "code"]).select("q", "distance", F.explode("ids").alias("id"))
        best = Window.partitionBy("q").orderBy("distance", "id")
        # an id with several codes takes one place, with its nearest
        both = hits.unionByName(answers).groupBy("q", "id").agg(F.min("distance").alias("distance"))
        both = both.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= _room(k))
        answers = materialize(both.drop("nth"), work_dir(spark))
        covered = m * radius + max(segments)
        state = answers.groupBy("q").agg(F.count("*").alias("n"), F.max("distance").alias("kth"))
        full = F.col("n") >= _room(k)
        active = (active.join(state, "q", "left")
                  .withColumn("bound", F.when(full, F.col("kth")).otherwise(F.col("bound")))
                  .where(F.col("bound") > covered).select("q", "bound"))
        active = materialize(active, work_dir(spark))
        if active.isEmpty():
            break
    named = asked.select(F.col("id").alias("query_id"), F.col("code").alias("q")).join(answers, "q").where("id <> query_id")
    nearest = named.groupBy("query_id", "id").agg(F.min("distance").alias("distance"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "id"))
    return nearest.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "id", "distance")


def _least_bound(code: Column, seeds: list[int], place: int, bits: int) -> Column:
    """The distance within which `code` has `place` seeds, which belong to different ids; with fewer seeds, more than any distance."""
    if len(seeds) < place:
        return F.lit(bits + 1)
    listed = F.split(F.lit(",".join(map(str, seeds))), ",").cast("array<long>")
    return F.sort_array(F.transform(listed, lambda x: F.bit_count(code.bitwiseXOR(x))))[place - 1]


def _room(k: int) -> int:
    """Answers a query code keeps: one more than k, as its own id is dropped at the end."""
    return k + 1
