"""Shards along a Hilbert curve over several metadata dimensions.

Each dimension is quantised to the same number of bits: numbers by quantiles, texts by their place among the distinct values. The
curve visits every cell once and goes only to neighbours, so a run of it is compact in all dimensions at once, and the smallest and
largest value of each column in a file written from a run rule out most files for a filter on any of them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from rideflow.llm.positions import with_position

LAWS = ("rows", "bytes")


def with_hilbert_index(df: DataFrame, cells: list[str], bits: int, name: str = "curve") -> DataFrame:
    """`df` with each row's place on the curve through the cube of side 2**bits; `cells` are columns of whole numbers in it.

    From the highest bit down, one bit of each dimension names the part of the cube that holds the cell. `entry` and `axis` say how
    the curve runs through the current cube: undoing that and inverting the Gray code gives the part's number along the curve.
    """
    n = len(cells)
    if n < 2 or n * bits > 62:
        raise ValueError("the index needs two dimensions or more, and 62 bits at most")

    def turn_left(x: str, by: str) -> str:
        return f"((shiftleft({x}, {by}) | shiftrightunsigned({x}, {n} - ({by}))) & {(1 << n) - 1})"

    part = " | ".join(f"shiftleft(shiftright(_cells[{i}], bit) & 1, {i})" for i in range(n))
    turned = turn_left("(part ^ acc.entry)", f"(({n} - (acc.axis + 1) % {n}) % {n})")
    number = " ^ ".join(f"shiftrightunsigned(turned, {i})" for i in range(n))
    even = "int((w - 1) div 2 * 2)"
    corner = f"(CASE WHEN w = 0 THEN 0 ELSE {even} ^ shiftright({even}, 1) END)"
    odd = "(CASE WHEN w = 0 THEN 0 WHEN w % 2 = 0 THEN w - 1 ELSE w END)"
    steps = f"""
        aggregate(sequence({bits - 1}, 0), named_struct('entry', 0, 'axis', 0, 'place', 0L), (acc, bit) ->
          transform(transform(transform(array({part}), part -> {turned}), turned -> {number}), w -> named_struct(
            'entry', acc.entry ^ {turn_left(corner, f'((acc.axis + 1) % {n})')},
            'axis', (acc.axis + int(bit_count({odd} ^ ({odd} + 1)))) % {n},
            'place', shiftleft(acc.place, {n}) | bigint(w)))[0], acc -> acc.place)"""
    return df.withColumn("_cells", F.array(*[F.col(c).cast("int") for c in cells])).withColumn(name, F.expr(steps)).drop("_cells")


def with_cells(df: DataFrame, dims: list[str], bits: int) -> DataFrame:
    """`df` with a column `_cell_i` for each dimension, from 0 to 2**bits - 1; null and NaN fall into cell 0.

    The quantiles of all numeric dimensions come to the driver as one row of 2**bits - 1 values each. The distinct values of a
    text dimension stay a table; its join can be split for a value with very many rows.
    """
    side = 1 << bits
    texts = [i for i, d in enumerate(dims) if isinstance(df.schema[d].dataType, StringType)]
    numbers = [i for i in range(len(dims)) if i not in texts]
    shares = [k / side for k in range(1, side)]
    cuts = df.agg(*[F.percentile_approx(F.col(dims[i]).cast("double"), shares).alias(str(i)) for i in numbers]).first() if numbers else {}
    for i in numbers:
        value = F.col(dims[i]).cast("double")
        below = [F.when(value > F.lit(c), 1).otherwise(0) for c in cuts[str(i)] or []]
        df = df.withColumn(f"_cell_{i}", F.when(F.isnan(value), 0).otherwise(reduce(lambda a, b: a + b, below, F.lit(0))))
    for i in texts:
        values = with_position(df.select(F.col(dims[i]).alias("_value")).where("_value IS NOT NULL").distinct(), [F.col("_value")])
        many = max(values.count(), 1)
        cells = values.select("_value", F.floor(F.col("position") * side / F.lit(many)).cast("int").alias(f"_cell_{i}"))
        df = df.join(cells, F.col(dims[i]) == F.col("_value"), "left").drop("_value").fillna(0, [f"_cell_{i}"])
    return df


def hilbert_shards(df: DataFrame, dims: list[str], n_shards: int, law: str = "rows", size: str | None = None, ties: tuple[str, ...] = (),
                   bits: int = 5) -> DataFrame:
    """`df` with curve, shard (0 to n_shards - 1) and slot (place in the shard, from 0).

    `law` "rows": counts of shards differ by one at most. "bytes": a row goes where the middle of its `size` (positive, not null) falls in
    the running sum. Rows of one cell follow each other by `ties`, so equal rows are neighbours; rows equal in all
    of these keep an arbitrary order. Null dimensions fall into the first cell, an empty table gives no rows. Columns of `df` may
    not be named like the results. No cell, value or source is gathered in one task: ranges are cut by (curve, ties).
    """
    if law not in LAWS:
        raise ValueError(f"law must be one of {LAWS}")
    cells = [f"_cell_{i}" for i in range(len(dims))]
    ordered = with_hilbert_index(with_cells(df, dims, bits), cells, bits).drop(*cells)
    placed = with_position(ordered, [F.col("curve"), *[F.col(t) for t in ties]], size if law == "bytes" else None)
    if law == "rows":
        many = placed.count()
        first = "position"
        placed = placed.withColumn("shard", F.expr(f"int(position * {n_shards} div {max(many, 1)})"))
    else:
        total = placed.agg(F.sum(size)).first()[0] or 1
        placed = placed.withColumn("shard", F.least(F.lit(n_shards - 1), F.floor(
            (F.col("before") + F.col(size) / 2) * n_shards / F.lit(float(total))).cast("int"))).drop("before")
        first = "position"
    starts = F.broadcast(placed.groupBy("shard").agg(F.min(first).alias("_start")))  # one row for each shard
    return placed.join(starts, "shard").withColumn("slot", F.col("position") - F.col("_start")).drop("position", "_start")


def write_shards(df: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """Write rows with their shards as one folder a shard, in curve order, so that files have narrow ranges of every dimension."""
    (df.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).partitionBy("shard").parquet(path))
