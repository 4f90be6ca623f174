"""Distributions: value counts, exact medians, profiles and drift."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rideflow.functions.numeric import percent, ratio


def value_counts(df: DataFrame, group: list[str], value: str, count: str = "n") -> DataFrame:
    """One row per group and value. Equal values are combined before the shuffle, and a group that
    holds most of the rows is spread over the cluster by its values."""
    return df.groupBy(*group, value).agg(F.count("*").alias(count))


def mark_middle(counts: DataFrame, group: list[str], value: str, count: str = "n", name: str = "is_middle") -> DataFrame:
    """Flag the value or the two values in the middle of each group's rows, given value counts.

    The window streams over sorted distinct values and can spill, so memory does not grow with them.
    """
    in_order = W.partitionBy(*group).orderBy(value)
    upto = F.sum(count).over(in_order.rowsBetween(W.unboundedPreceding, W.currentRow))
    whole = F.sum(count).over(W.partitionBy(*group))
    known = counts.filter(F.col(value).isNotNull()).withColumns({"_upto": upto, "_rows": whole})

    def holds(rank):
        return (F.col("_upto") >= rank) & (F.col("_upto") - F.col(count) < rank)

    lower, upper = F.floor((F.col("_rows") + 1) / 2), F.floor(F.col("_rows") / 2) + 1
    return known.withColumn(name, holds(lower) | holds(upper)).drop("_upto", "_rows")


def median_of(value: str, middle: str = "is_middle", scale: int = 2) -> Column:
    """Aggregate for rows flagged by `mark_middle`: the exact median, rounded half up."""
    return ratio(F.sum(F.when(F.col(middle), F.col(value))), F.count_if(F.col(middle)), scale)


def median_by(df: DataFrame, group: list[str], value: str, name: str = "median") -> DataFrame:
    """Exact interpolated median of `value` per group; groups without a value are left out."""
    counts = value_counts(df, group, value)
    return mark_middle(counts, group, value).groupBy(*group).agg(median_of(value).alias(name))


def profile(df: DataFrame, categories: list[str], measures: list[str]) -> DataFrame:
    """Counts per category value, and rows/min/max/mean/negative/zero per measure, as
    (column_name, statistic, value) rows. Categories are unpivoted so that one aggregation covers
    them all; partial counts are combined before the shuffle."""
    stats = []
    for m in measures:
        stats += [
            F.count(m).cast("decimal(18,2)").alias(f"{m}:count"),
            F.min(m).cast("decimal(18,2)").alias(f"{m}:min"),
            F.max(m).cast("decimal(18,2)").alias(f"{m}:max"),
            ratio(F.sum(m), F.count(m)).alias(f"{m}:mean"),
            F.count_if(F.col(m) < 0).cast("decimal(18,2)").alias(f"{m}:negative"),
            F.count_if(F.col(m) == 0).cast("decimal(18,2)").alias(f"{m}:zero"),
        ]
    shares = (df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.coalesce(F.col(c).cast("string"), F.lit("NULL")).alias("statistic"))
        for c in categories])).alias("x"))
        .groupBy("x.column_name", "x.statistic")
        .agg(F.count("*").cast("decimal(18,2)").alias("value")))
    if not stats:
        return shares
    wide = df.agg(*stats)
    tall = wide.unpivot([], wide.columns, "key", "value").select(
        F.split_part("key", F.lit(":"), F.lit(1)).alias("column_name"),
        F.split_part("key", F.lit(":"), F.lit(2)).alias("statistic"), "value")
    return shares.unionByName(tall) if categories else tall


def drift(df: DataFrame, column: str, period: str) -> DataFrame:
    """Share of each category per period and its change against the previous period, in percent
    points. Windows run over counts: one row per period and category."""
    counts = df.groupBy(F.col(period).alias("period"), F.col(column).alias("category")).agg(F.count("*").alias("n"))
    shares = counts.withColumn("share_pct", percent(F.col("n"), F.sum("n").over(W.partitionBy("period")), 2))
    previous = F.lag("share_pct").over(W.partitionBy("category").orderBy("period"))
    return shares.withColumn("change_pct", (F.col("share_pct") - previous).cast("decimal(18,2)"))
