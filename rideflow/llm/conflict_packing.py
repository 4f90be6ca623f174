"""Best-fit packing of documents into bins under conflicts.

A bin holds at most one document of a source and one of a cluster of duplicates. Open bins are kept in the order of their free room, each
with a bitmap of the sources and one of the clusters in it. A document searches from the tightest bin that has room for it
upwards until it meets one whose bitmaps are free of its own bits, and opens a bin if none is.

Packing one after the other is the work of one task, so documents are dealt to groups of bounded size by a hash, and every group packs its
own bins. A source or cluster with very many documents is spread evenly over all groups by that.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GROUP_ROWS = 4000


def pack(sizes: list[int], sources: list, clusters: list, capacity: int) -> list[int]:
    """Bin number of each document, which go in the given order; sizes are 1 to `capacity`, None conflicts with nothing."""
    source_bit = {s: 1 << i for i, s in enumerate(dict.fromkeys(s for s in sources if s is not None))}
    seen, twice = set(), {}
    for c in clusters:
        if c is not None and c in seen and c not in twice:
            twice[c] = 1 << len(twice)
        seen.add(c)
    least = [0] * (len(sizes) + 1)  # the smallest size still to come
    least[len(sizes)] = capacity + 1
    for i in range(len(sizes) - 1, -1, -1):
        least[i] = min(sizes[i], least[i + 1])
    open_bins: list[tuple[int, int]] = []  # (room, bin), ascending
    held: list[list[int]] = []
    result = []
    for i, (size, source, cluster) in enumerate(zip(sizes, sources, clusters, strict=True)):
        a, b = source_bit.get(source, 0), twice.get(cluster, 0)
        at = bisect_left(open_bins, (size, -1))
        while at < len(open_bins) and (held[open_bins[at][1]][0] & a or held[open_bins[at][1]][1] & b):
            at += 1
        if at < len(open_bins):
            room, number = open_bins.pop(at)
        else:
            room, number = capacity, len(held)
            held.append([0, 0])
        held[number][0] |= a
        held[number][1] |= b
        if room - size >= least[i + 1]:
            insort(open_bins, (room - size, number))
        result.append(number)
    return result


def conflict_packing(docs: DataFrame, capacity: int, group_rows: int = GROUP_ROWS, seed: int = 11) -> DataFrame:
    """doc_id, source, cluster, size, piece, start, length, bin of `docs` (doc_id, source, size, cluster), one row a piece.

    A document longer than `capacity` is cut into pieces of `capacity`, which fill bins of their own, and a last one, which is packed like a
    document; start and length are in the unit of size. Documents of size 0, or null, are in no bin: piece 0, length 0, bin null. Null
    sources and clusters conflict with nothing. In a group, larger documents go first, equal ones by doc_id, cluster and source, so reruns
    agree; equal rows count as copies, which only their cluster keeps apart. Bins of different groups have different numbers.
    A group is about `group_rows` documents, the unit that one task packs.
    """
    rows = docs.select("doc_id", "source", F.col("cluster").cast("string").alias("cluster"),
                       F.greatest(F.lit(0), F.coalesce("size", F.lit(0))).cast("long").alias("size"))
    n_groups = max(1, -(-rows.count() // group_rows))
    pieces = (rows.withColumn("cuts", F.greatest(F.lit(1), F.ceil(F.col("size") / capacity)))
              .withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cuts") - 1))).drop("cuts")
              .withColumn("start", F.col("piece") * capacity)
              .withColumn("length", F.least(F.lit(capacity), F.col("size") - F.col("start"))))
    # copies of a row share its hash, so what tells a row's place apart joins in
    key = F.xxhash64(F.lit(seed), "doc_id", "source", "cluster", "size", "piece")
    placed = pieces.withColumn("grp", F.pmod(key, F.lit(n_groups)))
    names = ["doc_id", "source", "cluster", "size", "piece", "start", "length"]

    def fill(frame: pd.DataFrame) -> pd.DataFrame:
        group = int(frame["grp"].iloc[0])
        frame = frame.sort_values(["length", "doc_id", "cluster", "source", "piece"], ascending=[False, True, True, True, True], kind="stable")
        some = frame[frame["length"] > 0]
        plain = lambda c: [None if pd.isna(x) else x for x in some[c]]
        bins = pack(some["length"].tolist(), plain("source"), plain("cluster"), capacity)
        out = frame[names].copy()
        out["bin"] = pd.array([pd.NA] * len(out), "Int64")
        out.loc[(frame["length"] > 0).to_numpy(), "bin"] = pd.array([group * (1 << 32) + b for b in bins], "Int64")
        return out

    kinds = {f.name: f.dataType.simpleString() for f in placed.schema.fields}
    return placed.groupBy("grp").applyInPandas(fill, ", ".join(f"{n} {kinds[n]}" for n in names) + ", bin long")
