"""Jaccard self-join of word shingle sets with adaptive multi-match prefixes.

Two sets of sizes a and b with similarity t share at least ceil(t * max(a, b)) shingles. If the shingles of all documents
follow one total order, and a document's prefix at level l is its first a - ceil(t * a) + l shingles, then
similar documents share at least min(l, l') shingles of their prefixes. A longer prefix finds more
partners in its lists but may ask for more shared shingles before a pair is verified, so every
document takes the level whose estimated cost (entries of its lists to read, plus the verifications they may
cause) is least.

The order: a fixed part of the hash range comes first, by ascending number of documents, then the rest by hash. The part is
wide enough to fill nearly every prefix, so only it is counted over the corpus, and shingles of one document
only, which make up most of a text, end most prefixes before any shared shingle. A document with too few of them adds its
smallest other hashes; the order holds for it as well, so no pair is lost.

Only documents with different sets are compared. Groups of near copies are not expanded into all their pairs: in
rounds, each shared shingle's documents are verified against one of them, drawn anew in each round, and pairs
within one component found so far are left out. When the remaining pairs are few against the size of the prefixes, or after
`ROUNDS` rounds, every remaining pair across components that shares enough prefix shingles is verified. So the components are
exact whatever the rounds have found.

A large family has many documents that are near its middle and nearly, but not quite, near each other, so its pairs to verify would grow with the square
of its size. So the hubs of the first round are not drawn: they are the documents whose prefixes are the most common, and a document keeps its difference
from the hub it meets most often, its anchor. With exact differences from one anchor, two documents differ in as many shingles as both differences
have, less twice what these share. Documents of one anchor are therefore compared by their differences (`_within`): those that need to share nothing link through the
one of the least difference, and others can link only if they share enough of the rare shingles in which they differ from the middle.
Only documents of different anchors are compared by their prefixes.

Documents of one family share most of their prefixes, so a pair would be made once for each of some hundred shingles. Every document
therefore carries its head, the `HEAD` smallest hashes of its prefix. The least common shingle of two heads is the least of the whole prefixes, so a
pair whose heads meet is made once, there; if its heads hold too few common ones to tell, the whole prefixes are counted, once for the pair.
Heads go by hash and not by frequency: so they are a sample of the prefix, which prefixes with much in common share, while the rarest
shingles of two documents of a family differ. Pairs whose heads do not meet have little in common and are made, and counted, at each shared shingle.

Pairs that cannot be similar are told where they meet: by their sizes, and by a parity bitmap of each set. Two sets differ in
at least as many shingles as their bitmaps differ in bits, so a pair with more different bits than the threshold leaves room
for is out, and no similar pair is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rideflow.llm.graph import components, discard, release
from rideflow.llm.words import mix, shingles, text_slices, words
from rideflow.sources.workdir import materialize, work_dir

LEVELS = 8
ROUNDS = 2
PARITY_BITS = 256
HEAD = 12
_TOP = 1 << 64


def _leading_share(percent: int) -> float:
    """Share of the hash range that comes first: somewhat more than a prefix needs."""
    return min(1.0, 1.1 * (100 - percent) / 100 + 0.02)


def _chosen(hashes: np.ndarray, percent: int) -> tuple[np.ndarray, int]:
    """The shingles a document takes part with, and how many of them are in the leading part. `hashes` ascend."""
    n = len(hashes)
    leading = int(np.searchsorted(hashes, np.uint64(int(_leading_share(percent) * _TOP) - 1), "right"))
    needed = min(n, n - -(-percent * n // 100) + LEVELS)
    return hashes[:max(leading, needed)], leading


def _node(hashes: np.ndarray) -> int | None:
    """A 64-bit hash of a whole set."""
    if not len(hashes):
        return None
    folded = np.bitwise_xor.reduce(mix(hashes), keepdims=True) + np.uint64(len(hashes))
    return int(mix(folded).view(np.int64)[0])


def _parity(hashes: np.ndarray) -> np.ndarray:
    """One bit for each value of the lowest bits of the hashes: whether an odd number of them has it; as longs."""
    odd = np.bincount((hashes & np.uint64(PARITY_BITS - 1)).astype(np.int64), minlength=PARITY_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _sets(docs: DataFrame, id_col: str, text_col: str, size: int, percent: int) -> DataFrame:
    """doc_id, node (a hash of the whole set), n, parity bits, leading, chosen shingles. Equal sets have equal nodes."""

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for first, end, data, offsets in text_slices(batch.column(1)):
                found = words(data, offsets)
                nodes, counts, leads, chosen, bits = [], [], [], [], []
                for lo, hi in zip(found.bounds[:-1], found.bounds[1:], strict=True):
                    hashes = shingles(found.hash[lo:hi], size)
                    part, leading = _chosen(hashes, percent)
                    nodes.append(_node(hashes))
                    counts.append(len(hashes))
                    leads.append(leading)
                    bits.append(_parity(hashes).tolist())
                    chosen.append(part.view(np.int64))
                values = np.concatenate(chosen) if chosen else np.zeros(0, np.int64)
                bounds = np.cumsum([0] + [len(c) for c in chosen], dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, end - first), pa.array(nodes, pa.int64()), pa.array(counts, pa.int64()),
                     pa.array(bits, pa.list_(pa.int64())), pa.array(leads, pa.int64()), pa.ListArray.from_arrays(pa.array(bounds), pa.array(values))],
                    names=["doc_id", "node", "n", "bits", "leading", "chosen"])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(convert, "doc_id long, node long, n long, bits array<long>, leading long, chosen array<long>"))


def _full_sets(docs: DataFrame, size: int) -> DataFrame:
    """node, hashes: the whole sets of `docs` (node, text), where the text's set is the node's. Another text under the
    same doc_id is left out."""

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in text_slices(batch.column(1)):
                found = words(data, offsets)
                nodes, each = [], [np.zeros(0, np.int64)]
                for i, node in enumerate(batch.column(0).slice(first, end - first).to_pylist()):
                    hashes = shingles(found.hash[found.bounds[i]:found.bounds[i + 1]], size)
                    if _node(hashes) == node:
                        nodes.append(node)
                        each.append(hashes.view(np.int64))
                bounds = np.cumsum([len(c) for c in each], dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes, pa.int64()), pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(each)))],
                    names=["node", "hashes"])

    return docs.select("node", "text").mapInArrow(convert, "node long, hashes array<long>")


def _prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """token, node, n, level, central: the prefixes at the chosen levels, of shingles that more than one set has, and how common those of the node are on average."""
    cut = int(_leading_share(percent) * _TOP) - 1
    # copies are combined before the shuffle; sizes join later, so that the rows of the large shuffles are two numbers
    tokens = sets.groupBy("node").agg(F.first("chosen").alias("chosen")).select("node", F.explode("chosen").alias("token"))
    counts = tokens.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    sizes = sets.groupBy("node").agg(F.first("n").alias("n"), F.first("leading").alias("leading"))
    shared = tokens.join(counts, "token").join(sizes, "node")
    # hashes ascend as unsigned numbers: negative longs are the upper half
    in_front = (F.col("token").between(0, min(cut, (1 << 63) - 1)) if cut < 1 << 63
                else (F.col("token") >= 0) | (F.col("token") <= cut - _TOP))
    shared = shared.withColumn("back", ~in_front)
    unsigned = F.col("token").bitwiseXOR(F.lit(-(1 << 63)))
    order = Window.partitionBy("node").orderBy("back", F.when(F.col("back"), F.lit(0)).otherwise(F.col("df")), unsigned)
    whole = Window.partitionBy("node")
    place = (F.col("leading") - F.sum(F.when(F.col("back"), 0).otherwise(1)).over(whole) + F.row_number().over(order))
    need = F.expr(f"(n * {percent} + 99) div 100")
    placed = (shared.withColumn("place", place).withColumn("short", F.col("n") - need).withColumn("need", need)
              .where(F.col("place") <= F.col("short") + LEVELS))
    lists = [F.sum(F.when(F.col("place") <= F.col("short") + lvl, F.col("df") - 1).otherwise(0)).over(whole)
             for lvl in range(1, LEVELS + 1)]
    placed = placed.withColumn("lists", F.array(*lists))
    # a list entry costs 1; each pair of it that survives costs a merge of two sets
    verify = F.col("n") / F.lit(16.0) + 4
    costs = [F.when(F.col("need") >= lvl, F.col("lists")[lvl - 1] * (1 + verify / lvl)) for lvl in range(1, LEVELS + 1)]
    placed = placed.withColumn("costs", F.array(*costs))
    placed = placed.withColumn("level", F.array_position("costs", F.array_min("costs")).cast("int"))
    placed = placed.withColumn("central", F.element_at("lists", F.col("level")) / (F.col("short") + F.col("level")))
    return placed.where(F.col("place") <= F.col("short") + F.col("level")).select("token", "node", "n", "level", "central")


def _may_be_similar(x: dict[str, Column], y: dict[str, Column], percent: int) -> Column:
    """False only for pairs below the threshold, by sizes (n) and parity bits."""
    total = x["n"] + y["n"]
    common = F.floor((total * percent + (99 + percent)) / F.lit(100 + percent))  # at least, rounded up
    apart = sum((F.bit_count(x["bits"][i].bitwiseXOR(y["bits"][i])) for i in range(PARITY_BITS // 64)), F.lit(0))
    return (F.least(x["n"], y["n"]) * 100 >= F.greatest(x["n"], y["n"]) * percent) & (apart <= total - 2 * common)


def _crossed(entries: DataFrame, percent: int) -> DataFrame:
    """a, b, level, once, met: pairs of different parts and anchors that share a shingle of their prefixes and may be similar. Those whose heads meet come once,
    with the number of shingles their heads share, the others at each shingle they share. `entries` are prefixes with part, anchor, bits, head and
    is_largest: whether the entry is of the shingle's largest part or anchor, within which no pair is made."""
    columns = ("node", "n", "level", "part", "anchor", "bits", "head")
    some = entries.where("NOT is_largest").select("token", *columns)
    other = entries.select("token", *[F.col(c).alias(f"{c}2") for c in columns], "is_largest")
    in_heads = F.array_intersect("head", "head2")
    once = F.size(in_heads) > 0
    return (some.join(other, "token")
            .where((F.col("part") != F.col("part2")) & (F.col("anchor") != F.col("anchor2")) & (F.col("is_largest") | (F.col("node") < F.col("node2")))
                   & _may_be_similar({c: F.col(c) for c in ("n", "bits")}, {c: F.col(f"{c}2") for c in ("n", "bits")}, percent)
                   & (~once | (F.col("token") == F.array_min(in_heads))))
            .select(F.least("node", "node2").alias("a"), F.greatest("node", "node2").alias("b"), F.least("level", "level2").alias("level"),
                    once.alias("once"), F.greatest(F.size(in_heads), F.lit(1)).alias("met")))


def _shared_enough(pairs: DataFrame, lists: DataFrame) -> DataFrame:
    """The pairs (a, b) of `pairs` (a, b, level) whose whole prefixes, `lists` (node, tokens), share at least `level` shingles."""
    asked = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    lists = lists.join(asked, "node")
    left = lists.select(F.col("node").alias("a"), F.col("tokens").alias("ta"))
    right = lists.select(F.col("node").alias("b"), F.col("tokens").alias("tb"))
    return pairs.join(left, "a").join(right, "b").where(F.size(F.array_intersect("ta", "tb")) >= F.col("level")).select("a", "b")


def _with_sides(entries: DataFrame, anchors: DataFrame) -> DataFrame:
    """`entries` with anchor (by `anchors`: node, anchor; else the node itself) and is_largest, which leaves out of a shingle's entries its largest part or its
    largest anchor, whichever is larger. Shingles of one anchor only have no pairs to make and are left out."""
    entries = entries.join(anchors, "node", "left").withColumn("anchor", F.coalesce("anchor", "node"))
    per_anchor = entries.groupBy("token", "anchor").agg(F.count("*").alias("n_anchor"))
    most = per_anchor.groupBy("token").agg(F.max(F.struct("n_anchor", "anchor")).alias("most"), F.count("*").alias("n_anchors")).where("n_anchors > 1")
    return (entries.join(most, "token")
            .withColumn("is_largest", F.expr("IF(most.n_anchor > largest.n_part, anchor = most.anchor, part = largest.part)")))


def _within(anchored: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """a, b: pairs of one anchor and different parts, so that the links among them join the parts that all links of the anchor's documents join.
    `anchored` are node, anchor, n, delta (the shingles that only one of node and anchor has), with n_anchor, the anchor's size.

    Sets of sizes n and m that differ in d shingles link when (100 + percent) * d <= (100 - percent) * (n + m). With s = (100 + percent) * |delta| - (100 - percent) * n
    that is: s + s2 <= 2 * (100 + percent) * shared, where shared is what both deltas have. If s + s2 <= 0, both link with the document of the least s.
    Else their deltas share some shingles, the first of which, the rarest first, is in both prefixes, as the smaller delta lacks at most half of d and the larger
    at most d. From there on (`rest`) both must have enough shingles. Those that only one delta has are the rarest and need no row.
    """
    own = anchored.select("node", "anchor", "n", "delta")
    hubs = anchored.select(F.col("anchor").alias("node"), "anchor", F.col("n_anchor").alias("n"), F.expr("CAST(array() AS array<long>)").alias("delta"))
    members = own.unionByName(hubs.dropDuplicates(["node"]).join(own.select("node"), "node", "left_anti")).join(parts.select("node", "part", "bits"), "node")
    scored = members.withColumn("s", F.size("delta") * (100 + percent) - F.col("n") * (100 - percent))
    groups = scored.groupBy("anchor").agg(F.min(F.struct("s", "node", "part")).alias("least"), F.min("part").alias("lo"), F.max("part").alias("hi"))
    scored = scored.join(groups.where("lo < hi").select("anchor", "least"), "anchor")
    through = (scored.where("part <> least.part AND s + least.s <= 0")
               .select(F.least("node", "least.node").alias("a"), F.greatest("node", "least.node").alias("b")))

    tokens = scored.select("anchor", "node", F.explode("delta").alias("token"))
    counts = tokens.groupBy("anchor", "token").agg(F.count("*").alias("df")).where("df > 1")
    whole = Window.partitionBy("node")
    shared = (tokens.join(counts, ["anchor", "token"])
              .withColumn("rank", F.row_number().over(whole.orderBy("df", "token"))).withColumn("n_shared", F.count("*").over(whole)))
    sizes = scored.select("node", "n", "part", "bits", "s", F.size("delta").alias("n_delta"))
    entries = (shared.join(sizes, "node").withColumn("place", F.col("n_delta") - F.col("n_shared") + F.col("rank"))
               .withColumn("rest", F.col("n_shared") - F.col("rank") + 1)
               .withColumn("apart", F.expr(f"n * {100 - percent} div {percent}")).where("place <= apart + 1"))
    columns = ("node", "n", "part", "bits", "s", "rest", "n_delta")
    larger = entries.select("anchor", "token", *columns)
    smaller = entries.where("place <= apart div 2 + 1").select("anchor", "token", *[F.col(c).alias(f"{c}2") for c in columns])
    by_delta = (larger.join(smaller, ["anchor", "token"])
                .where((F.col("part") != F.col("part2")) & (F.struct("n_delta2", "node2") < F.struct("n_delta", "node"))
                       & (F.col("s") + F.col("s2") <= F.least("rest", "rest2") * 2 * (100 + percent))
                       & _may_be_similar({c: F.col(c) for c in ("n", "bits")}, {c: F.col(f"{c}2") for c in ("n", "bits")}, percent))
                .select(F.least("node", "node2").alias("a"), F.greatest("node", "node2").alias("b")))
    return through.unionByName(by_delta).distinct()


def _compared(pairs: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, is_anchor), whether they link, and for those with an anchor b that has at least half of both sets in common, the sizes and the
    shingles that only one has; else null."""
    left = full.select(F.col("node").alias("a"), F.col("hashes").alias("ha"))
    right = full.select(F.col("node").alias("b"), F.col("hashes").alias("hb"))
    common = F.size(F.array_intersect("ha", "hb"))
    union = F.size("ha") + F.size("hb") - F.col("common")
    delta = F.when(F.col("is_anchor") & (F.col("common") * 2 >= union), F.concat(F.array_except("ha", "hb"), F.array_except("hb", "ha")))
    return (pairs.join(left, "a").join(right, "b").withColumn("common", common)
            .select("a", "b", (F.col("common") * 100 >= union * percent).alias("linked"), F.size("ha").cast("long").alias("n"),
                    F.size("hb").cast("long").alias("n_anchor"), delta.alias("delta")))


def _verified(pairs: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough, by whole sets."""
    left = full.select(F.col("node").alias("a"), F.col("hashes").alias("ha"))
    right = full.select(F.col("node").alias("b"), F.col("hashes").alias("hb"))
    common = F.size(F.array_intersect("ha", "hb"))
    union = F.size("ha") + F.size("hb") - F.col("common")
    return (pairs.join(left, "a").join(right, "b").withColumn("common", common)
            .where(F.col("common") * 100 >= union * percent).select("a", "b"))


def _relabel(members: DataFrame, links: DataFrame) -> DataFrame:
    """`members` (node, part, bits, head, central) after joining the parts that `links` (a, b: parts) connect."""
    merged = components(links).withColumnsRenamed({"node": "part", "label": "joined"})
    return members.join(merged, "part", "left").select("node", "bits", "head", "central", F.coalesce("joined", "part").alias("part"))


def ngram_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5,
               percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of `docs`.

    A-Z count as a-z. A document's set: its distinct runs of `size` words; with fewer words all of them as one; none without
    words. Two documents link when 100 * common >= percent * union. component_id is the smallest doc_id
    that links reach, the document's own included. Null or blank texts link with nothing. Rows with equal doc_id
    are one document: they share a component. Rows without a doc_id link with nothing; their component is null. Sets and shingles are compared by 64-bit hashes. Other columns are ignored.
    """
    spark = docs.sparkSession
    first, entry_dir, list_dir, part_dir = work_dir(spark), work_dir(spark), work_dir(spark), work_dir(spark)
    sets = materialize(_sets(docs, id_col, text_col, size, percent), first)
    linkable = sets.where("doc_id IS NOT NULL AND n > 0")
    prefixes = materialize(_prefixes(linkable, percent), entry_dir)
    release(spark)
    lists = materialize(prefixes.groupBy("node").agg(F.array_sort(F.collect_list("token")).alias("tokens"), F.first("central").alias("central")), list_dir)
    prefixes = prefixes.drop("central")
    met = lists.select("node", "central", F.slice("tokens", 1, HEAD).alias("head"))
    bits = linkable.groupBy("node").agg(F.first("bits").alias("bits"))
    parts = materialize(met.join(bits, "node").withColumn("part", F.col("node")), part_dir)
    # the shingles are not read again
    sets = materialize(sets.select("doc_id", "node", "n"), work_dir(spark))
    discard(spark, first)
    linkable = sets.where("doc_id IS NOT NULL AND n > 0")
    whom = linkable.groupBy("node").agg(F.min("doc_id").alias("doc_id"))

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    anchored, anchor_dir = None, work_dir(spark)
    release(spark)
    for turn in range(ROUNDS + 1):
        scratch = work_dir(spark)
        entries = prefixes.join(parts, "node")
        per_part = entries.groupBy("token", "part").agg(F.count("*").alias("n_part"))
        per_token = per_part.groupBy("token").agg(F.sum("n_part").alias("n_all"), F.count("*").alias("n_parts"),
                                                  F.max(F.struct("n_part", "part")).alias("largest")).where("n_parts > 1")
        per_token = materialize(per_token, f"{scratch}/per_token")
        totals = per_token.agg(F.sum(F.expr("(n_all - largest.n_part) * n_all")), F.sum("n_all")).first()
        if not totals[0]:
            break
        last = turn == ROUNDS or totals[0] <= 8 * totals[1] + 100_000
        open_entries = entries.join(per_token, "token")
        if last:
            if anchored is None:
                sided = open_entries.withColumn("anchor", F.col("node")).withColumn("is_largest", F.expr("part = largest.part"))
            else:
                sided = _with_sides(open_entries, anchored.select("node", "anchor"))
            crossed = _crossed(sided, percent)
            crossed = crossed.groupBy("a", "b").agg(F.sum("met").alias("common"), F.min("level").alias("level"), F.max("once").alias("once"))
            crossed = materialize(crossed.where("once OR common >= level"), f"{scratch}/crossed")
            pairs = (crossed.where("common >= level").select("a", "b")
                     .unionByName(_shared_enough(crossed.where("common < level").select("a", "b", "level"), lists)))
            if anchored is not None:
                pairs = pairs.unionByName(_within(anchored, parts, percent))
        else:
            rank = F.xxhash64("node", F.lit(turn)) if turn else -F.col("central")
            drawn = (open_entries.groupBy("token")
                     .agg(F.min(F.struct(rank.alias("rank"), "node", "n", "part", "bits")).alias("hub"))
                     .select("token", "hub"))
            may_link = ((F.col("part") != F.col("hub.part"))
                        & _may_be_similar({c: F.col(c) for c in ("n", "bits")}, {c: F.col(f"hub.{c}") for c in ("n", "bits")}, percent))
            met_hubs = open_entries.join(drawn, "token").select(F.col("node").alias("a"), F.col("hub.node").alias("b"), may_link.alias("may_link"))
            if turn:
                pairs = met_hubs.where("may_link").select("a", "b").distinct()
            else:
                # the hub of at least two thirds of a prefix is the anchor, if two documents more have it: fewer make few pairs
                often = met_hubs.groupBy("a", "b", "may_link").agg(F.count("*").alias("times"))
                each = Window.partitionBy("a")
                often = (often.withColumn("most", F.max(F.struct("times", "b")).over(each)).withColumn("all", F.sum("times").over(each))
                         .withColumn("is_anchor", F.expr("b <> a AND b = most.b AND times * 3 >= all * 2")).where("may_link OR is_anchor"))
                followed = often.where("is_anchor").groupBy("b").agg(F.count("*").alias("n_followers")).where("n_followers > 2")
                pairs = (often.join(followed, "b", "left").withColumn("is_anchor", F.expr("is_anchor AND n_followers IS NOT NULL"))
                         .where("may_link OR is_anchor").select("a", "b", "is_anchor"))
        pairs = materialize(pairs, f"{scratch}/pairs")
        # whole sets are larger than texts, so only documents of a pair get theirs
        asked = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        full = _full_sets(whom.join(asked, "node").join(texts, "doc_id").select("node", "text"), size)
        full = materialize(full.groupBy("node").agg(F.first("hashes").alias("hashes")), f"{scratch}/full")
        release(spark)
        if turn == 0 and not last:
            compared = materialize(_compared(pairs, full, percent), anchor_dir)
            links = compared.where("linked").select("a", "b")
            anchored = compared.where("delta IS NOT NULL").select(F.col("a").alias("node"), F.col("b").alias("anchor"), "n", "n_anchor", "delta")
        else:
            links = materialize(_verified(pairs, full, percent), f"{scratch}/links")
        by_part = (links.join(parts.select(F.col("node").alias("a"), F.col("part").alias("pa")), "a")
                   .join(parts.select(F.col("node").alias("b"), F.col("part").alias("pb")), "b")
                   .select(F.col("pa").alias("a"), F.col("pb").alias("b")))
        old, part_dir = part_dir, work_dir(spark)
        parts = materialize(_relabel(parts, by_part), part_dir)
        discard(spark, scratch)
        discard(spark, old)
        release(spark)
        if last:
            break
    discard(spark, entry_dir)
    discard(spark, list_dir)
    discard(spark, anchor_dir)

    grouped = whom.join(parts.select("node", "part"), "node", "left").withColumn("part", F.coalesce("part", "node"))
    # rows of one doc_id with several texts join the parts of those texts
    labels = materialize(grouped.groupBy("part").agg(F.min("doc_id").alias("component_id")), work_dir(spark))
    known = F.when(F.col("doc_id").isNotNull(), F.col("node")).alias("node")
    named = (sets.select("doc_id", known, "n").join(grouped.select("node", "part"), "node", "left")
             .join(labels, "part", "left"))
    named = materialize(named.select("doc_id", "n", F.coalesce("component_id", "doc_id").alias("component_id")), work_dir(spark))
    split = named.groupBy("doc_id").agg(F.min("component_id").alias("lo"), F.max("component_id").alias("hi")).where("lo < hi")
    ties = (named.join(split.select("doc_id", "lo"), "doc_id")
            .select(F.col("component_id").alias("a"), F.col("lo").alias("b")))
    merged = components(ties).withColumnsRenamed({"node": "component_id", "label": "least"})
    return (named.join(merged, "component_id", "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "component_id").alias("component_id")))

