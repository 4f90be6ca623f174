"""First row per key, without ever sorting a whole key group in one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rideflow.sources.workdir import materialize

def _total_order(df: DataFrame, order: list[str]) -> list[str]:
    """`order` followed by every other column, so only identical rows can tie."""
    return list(order) + [c for c in df.columns if c not in order]


def first_per_key(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """One row per key: the smallest by `order`, then by the remaining columns.

    MIN over a struct combines on the map side, so a key with most of the rows sends one row per
    task. NULLs sort first, in `order` and in the tie-break alike.
    """
    columns = df.columns
    rest = [c for c in _total_order(df, order) if c not in key]
    if not rest:
        return df.distinct()
    best = df.groupBy(*key).agg(F.min(F.struct(*rest)).alias("_row"))
    return best.select(*key, "_row.*").select(*columns)


def latest_per_key(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """One row per key: the largest by `order`, then by the remaining columns."""
    columns = df.columns
    rest = [c for c in _total_order(df, order) if c not in key]
    best = df.groupBy(*key).agg(F.max(F.struct(*rest)).alias("_row"))
    return best.select(*key, "_row.*").select(*columns)


def mark_first(df: DataFrame, key: list[str], order: list[str], eligible: Column | None = None,
               name: str = "is_first", copies: int | None = None) -> DataFrame:
    """Keep every row and flag exactly one eligible row per key.

    Where the caller knows that no key has more than 10,000 rows (`copies`), the rows of a key meet at once and are shuffled
    once. Else two rounds. The first ranks inside (key, input partition), so no group is larger than one input
    partition. Only its winners meet in the second round, at most one per key and input partition.
    Ineligible rows, NULL keys included, never meet anyone.
    """
    ordering = [F.col(c) for c in _total_order(df, order) if c not in key]
    if copies is not None and copies <= 10_000:
        # rows without a key and ineligible ones are no key's first; they are dealt by their other columns, as they would meet in one task
        out = reduce(lambda x, y: x | y, [F.col(k).isNull() for k in key])
        out = out if eligible is None else out | ~F.coalesce(eligible, F.lit(False))
        meeting = F.when(out, F.xxhash64(*ordering))
        return df.withColumn(name, ~out & (F.row_number().over(W.partitionBy(*key, meeting).orderBy(*ordering)) == 1))
    eligible = F.lit(True) if eligible is None else eligible
    for k in key:
        eligible = eligible & F.col(k).isNotNull()
    sliced = df.withColumn("_slice", F.spark_partition_id()).withColumn("_eligible", F.coalesce(eligible, F.lit(False)))
    local = F.row_number().over(W.partitionBy(*key, "_slice", "_eligible").orderBy(*ordering))
    contenders = sliced.withColumn("_contender", F.col("_eligible") & (local == 1))
    meeting = F.when(F.col("_contender"), F.lit(-1)).otherwise(F.col("_slice"))
    final = F.row_number().over(W.partitionBy(*key, meeting).orderBy(*ordering))
    return (contenders.withColumn(name, F.col("_contender") & (final == 1))
            .drop("_slice", "_eligible", "_contender"))


def duplicated_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*key).agg(F.count("*").alias("copies")).filter("copies > 1")


_WORD = 8 * 4096  # bits of one bitmap that Spark aggregates


def _bitmap(keys: DataFrame, key: list[str], rows: int, stage_in: str, most_bits: int, turn: int = 0) -> tuple[DataFrame, int, int]:
    """The hashes of the `rows` stored `keys` as set bits, with the number of bits and the turn, which chooses the hash."""
    bits = min(most_bits, max(_WORD, 1 << (16 * rows - 1).bit_length()))
    place = _place(key, bits, turn)
    spots = keys.select(F.floor(place / _WORD).cast("int").alias("_part"), (place % _WORD).alias("_bit"))
    parts = spots.groupBy("_part").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    # as numbers of 64 bits, so that a row reads the one it needs instead of copying the part
    eight = lambda i: F.conv(F.hex(F.substring("_bits", i * 8 + 1, F.lit(8))), 16, -10).cast("bigint")
    words = F.transform(F.sequence(F.lit(0), F.lit(_WORD // 64 - 1)), eight)
    return materialize(parts.select("_part", words.alias("_words")), stage_in), bits, turn


def _place(key: list[str], bits: int, turn: int) -> Column:
    return F.pmod(F.xxhash64(*key, *([F.lit(turn)] if turn else [])), F.lit(bits))


def _hit(df: DataFrame, key: list[str], bitmap: tuple[DataFrame, int, int], name: str) -> DataFrame:
    """`df` with a flag that tells whether the bit of its key is set; false for NULL keys."""
    stored, bits, turn = bitmap
    place = _place(key, bits, turn)
    known = reduce(lambda x, y: x & y, [F.col(k).isNotNull() for k in key])
    placed = df.withColumns({"_at": F.floor(place / _WORD).cast("int"), "_in": (place % _WORD).cast("int")})
    # the first byte of eight is the highest of their number
    word = F.get("_words", F.shiftright("_in", 6))
    bit = F.getbit(word, F.col("_in").bitwiseAND(F.lit(63)).bitwiseXOR(F.lit(56)))
    flag = F.coalesce(known & (bit == 1), F.lit(False))
    return placed.join(F.broadcast(stored), F.col("_at") == F.col("_part"), "left").withColumn(name, flag).drop("_at", "_in", "_part", "_words")


def flag_members(df: DataFrame, keys: DataFrame, key: list[str], rows: int, stage_in: str, name: str = "_listed", most_bits: int = 1 << 28,
                 column: str | None = None) -> DataFrame:
    """`df` with a flag that is true for every row whose key is among the `rows` stored `keys`, and for a few others, without shuffling `df`.

    The hashes of the keys set 1 of 16 bits, in a map of `most_bits` (32 MB) at most, which every task reads whole; it has that size however many keys
    there are, so it can be broadcast. About a 16th of the other rows are flagged, more where the map is full; who asks must
    be right for these too. NULL keys are not flagged. Where a single key is a `column` of another name in `df`, give that."""
    return _hit(df, [column] if column else key, _bitmap(keys, key, rows, stage_in, most_bits), name)


def flag_exactly(df: DataFrame, column: str, keys: DataFrame, stage_in: str, name: str = "_listed", few: int = 100_000, most_bits: int = 1 << 28,
                 turns: int = 8) -> DataFrame:
    """`df` with a flag that is true for exactly the rows whose `column` is listed, without shuffling `df`. `keys`, stored, has every value of the column
    but NULL once as `_key`, with `_in`, which says whether it is listed. NULL is not flagged.

    Up to `few` keys of one kind are broadcast as they are. More of them become a bitmap; the keys of the other kind that it takes for them, about a
    16th, are the next ones to be told apart, by another hash, and so on until few are left. Where the maps are so full that `turns` do
    not get there, the rest is joined as Spark sees fit."""
    counts = {r[0]: r[1] for r in keys.groupBy("_in").count().collect()}
    kind = counts.get(True, 0) <= counts.get(False, 0)
    inside, outside = (keys.filter(F.col("_in") == side).select("_key") for side in (kind, not kind))
    rows, bitmaps = counts.get(kind, 0), []
    while rows > few and len(bitmaps) < turns:
        bitmap = _bitmap(inside, ["_key"], rows, f"{stage_in}/bits_{len(bitmaps)}", most_bits, len(bitmaps))
        taken = _hit(outside, ["_key"], bitmap, "_hit").filter("_hit").select("_key")
        inside, outside = materialize(taken, f"{stage_in}/taken_{len(bitmaps)}"), inside
        rows = inside.count()
        bitmaps.append(bitmap)
    left = inside.select(F.col("_key").alias("_left"))
    out = df.join(F.broadcast(left) if rows <= few else left, F.col(column) == F.col("_left"), "left") if rows else df.withColumn("_left", F.lit(None).cast("string"))
    found = F.col("_left").isNotNull()
    for bitmap in reversed(bitmaps):
        out = _hit(out, [column], bitmap, f"_hit_{bitmap[2]}")
        found = F.col(f"_hit_{bitmap[2]}") & ~found
    flag = found if kind else F.col(column).isNotNull() & ~found
    return out.withColumn(name, flag).drop("_left", *[f"_hit_{turn}" for _stored, _bits, turn in bitmaps])


def flag_listed(df: DataFrame, column: str, listed: DataFrame, stage_in: str, name: str = "_listed", few: int = 100_000) -> DataFrame:
    """`df` with a flag that is true for exactly the rows whose `column` is among the stored `listed` keys (`_key`, each once), which `df` need not hold. Only the
    keys of `df` are shuffled, each once from every task."""
    own = df.select(F.col(column).alias("_key")).filter("_key IS NOT NULL").distinct()
    found = own.join(listed.select(F.col("_key").alias("_found")), F.col("_key") == F.col("_found"), "left")
    keys = materialize(found.select("_key", F.col("_found").isNotNull().alias("_in")), f"{stage_in}/own")
    return flag_exactly(df, column, keys, stage_in, name, few)


def rows_with_duplicated_key(df: DataFrame, key: str, stage_in: str | None = None) -> DataFrame:
    """All rows whose key occurs more than once. With `stage_in` the list of such keys is stored
    first, so that Spark can broadcast it by its size, or split a hot key in the join."""
    keys = duplicated_keys(df, [key]).select(key)
    return df.join(materialize(keys, stage_in) if stage_in else keys, key, "left_semi")
