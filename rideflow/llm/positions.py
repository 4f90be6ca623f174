"""Places of rows in a total order, without one task that sees them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rideflow.sources.workdir import materialize, work_dir


def with_position(df: DataFrame, order: list[Column], weight: str | None = None) -> DataFrame:
    """`df` with `position`, each row's place (from 0) in the given order; the order of rows equal in it is arbitrary but
    fixed. With `weight`, a column of numbers without nulls, also `before`: the sum over the rows in front of it.

    The rows are dealt by ranges, sorted, and written; a row's number within its range comes from the written order, and
    only the counts of the ranges, one row each, are summed up.
    """
    spark = df.sparkSession
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    # the id has the range's number in its upper bits and the row's number within it in the lower 33
    numbered = materialize(dealt.withColumn("_at", F.monotonically_increasing_id()), work_dir(spark))
    numbered = numbered.withColumn("_range", F.shiftright("_at", 33))
    sums = numbered.groupBy("_range").agg(F.count("*").alias("_n"), F.sum(weight or F.lit(0)).alias("_w"))
    above = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # one row for each range, that is for each shuffle partition: small whatever the input
    offsets = F.broadcast(sums.select("_range", *[F.coalesce(F.sum(c).over(above), F.lit(0)).alias(f"{c}0") for c in ("_n", "_w")]))
    placed = numbered.join(offsets, "_range").withColumn("position", F.col("_n0") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
    if weight:
        inside = Window.partitionBy("_range").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
        placed = placed.withColumn("before", F.col("_w0") + F.coalesce(F.sum(weight).over(inside), F.lit(0)))
    return placed.drop("_at", "_range", "_n0", "_w0")
