"""Shares, ranks, rolling means and growth. Windows only ever see aggregated rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rideflow.functions.numeric import percent, ratio


def share_of_total(aggregated: DataFrame, measure: str, name: str, scale: int = 1) -> DataFrame:
    """Percentage of the grand total of `measure`. The frame must already be aggregated: the
    unpartitioned window sees one row per group."""
    return aggregated.withColumn(name, percent(F.col(measure), F.sum(measure).over(W.partitionBy()), scale))


def ranked(aggregated: DataFrame, measure: str, group: list[str] | None = None, name: str = "rank",
           dense: bool = False) -> DataFrame:
    """RANK (or DENSE_RANK) of each row by `measure` descending, within `group`.

    The rank of a value is 1 + the number of rows with a larger value, so it is computed on the
    value counts and joined back. No group of rows is sorted in one task; the window sees distinct
    values only. For a count measure these are at most about the square root of twice its total.
    """
    group = group or []
    counts = aggregated.groupBy(*group, measure).agg(F.count("*").alias("_rows"))
    above = W.partitionBy(*group).orderBy(F.desc_nulls_last(measure)).rowsBetween(W.unboundedPreceding, -1)
    step = F.lit(1).cast("bigint") if dense else F.col("_rows")
    ranks = counts.select(*group, measure, (F.lit(1) + F.coalesce(F.sum(step).over(above), F.lit(0))).alias(name))
    left, right = aggregated.alias("l"), ranks.alias("r")
    same = F.lit(True)
    for c in [*group, measure]:
        same = same & F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
    return left.join(right, same).select("l.*", f"r.{name}")


def daily_counts(df: DataFrame, ts: str, day: str = "day", count: str = "rides") -> DataFrame:
    """Rows per calendar day, with 0 for the days in between that have none."""
    counts = df.groupBy(F.to_date(ts).alias(day)).agg(F.count("*").alias(count))
    span = counts.agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    calendar = span.select(F.explode(F.sequence("lo", "hi")).alias(day))
    return calendar.join(counts, day, "left").select(day, F.coalesce(count, F.lit(0)).alias(count))


def rolling_mean(daily: DataFrame, day: str, measure: str, days: int = 7, name: str = "rolling_avg") -> DataFrame:
    """Mean of the previous `days` days, the day itself excluded; NULL on the first day.
    The window sees one row per calendar day."""
    before = W.orderBy(day).rowsBetween(-days, -1)
    return daily.withColumn(name, ratio(F.sum(measure).over(before).cast("decimal(18,0)"), F.count(measure).over(before)))


def growth(monthly: DataFrame, period: str, measure: str, name: str = "growth_pct") -> DataFrame:
    """Change against the previous period in percent. The window sees one row per period."""
    previous = F.lag(measure).over(W.orderBy(period))
    return monthly.withColumn(name, percent(F.col(measure) - previous, previous))
