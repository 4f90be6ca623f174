"""Slowly changing dimensions and upserts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rideflow.operators.dedupe import first_per_key, latest_per_key
from rideflow.sources.workdir import materialize, work_dir


def scd2(snapshots: DataFrame, key: str, attrs: list[str], snapshot_date: str) -> DataFrame:
    """Validity intervals [valid_from, valid_to) per version of `attrs`.

    Snapshots are first cut to one row per key and DATE (combined on the map side), so a window
    group has at most one row per snapshot day, however often a key was delivered.
    """
    per_day = first_per_key(
        snapshots.select(key, F.to_date(snapshot_date).alias("_day"), *attrs), [key, "_day"], list(attrs))
    timeline = W.partitionBy(key).orderBy("_day")
    version = F.struct(*attrs)
    changed = F.lag(version).over(timeline).eqNullSafe(version)
    starts = per_day.withColumn("_same", F.coalesce(changed, F.lit(False))).filter(~F.col("_same"))
    end = F.lead("_day").over(timeline)
    return starts.select(key, *attrs, F.col("_day").alias("valid_from"), end.alias("valid_to"),
                         end.isNull().alias("is_current"))


def upsert(current: DataFrame, changes: DataFrame, key: str, order: str) -> DataFrame:
    """Merge: the newest row per key by `order`; at equal order the change wins."""
    both = (current.withColumn("_source", F.lit(0))
            .unionByName(changes.select(*current.columns).withColumn("_source", F.lit(1))))
    return latest_per_key(both, [key], [order, "_source"]).drop("_source")


def _slice(at: Column, hours: int) -> Column:
    """The number of the stretch of `hours` that a time lies in; times after 1970 and before alike."""
    return F.floor((F.unix_date(F.to_date(at)).cast("long") * 24 + F.hour(at)) / F.lit(hours)).cast("long")


def as_of(events: DataFrame, versions: DataFrame, key: str, at: str, valid_from: str, carry: list[str], open_start: bool = False,
          hours: int = 24, compared: int = 32) -> DataFrame:
    """`events` with the `carry` columns of the version of their key that was valid at their time: the newest with valid_from <= at, NULL if there
    is none. With `open_start` the first version of a key holds for the time before it as well. A NULL key or time gets NULL. Every event
    comes out once, repeated ones too; versions have one row per key and valid_from.

    Where no key has more than `compared` versions, as usual for a dimension, an event meets the versions of its key in an equality join, which Spark can
    broadcast by size and split for a hot key; no event is sorted. Beyond that, versions and events are merged in one stream in the order of time, which carries the last version forward. A stream covers one key and one stretch of
    `hours`, so a key with most of the events is cut by time. Each stream starts with the last version before it, which a first pass finds
    from one row for each key and stretch."""
    names = events.columns
    clash = set(carry) & set(names)
    if clash:
        raise ValueError(f"events have columns {sorted(clash)} already")
    own = versions.select(F.col(key).alias("_key"), F.col(valid_from).cast("timestamp_ntz").alias("_at"), F.struct(*carry).alias("_version")).where("_key IS NOT NULL")
    if (own.groupBy("_key").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0) <= compared:
        by_time = W.partitionBy("_key").orderBy("_at")
        first = F.row_number().over(by_time) == 1
        intervals = own.select("_key", "_version", F.when(~first if open_start else F.lit(True), F.col("_at")).alias("_at"), F.lead("_at").over(by_time).alias("_until"))
        # stored, so that the join shuffles it by itself and can split a hot key
        intervals = materialize(intervals, work_dir(events.sparkSession))
        then = F.col(at).cast("timestamp_ntz")
        inside = then.isNotNull() & (F.col("_at").isNull() | (F.col("_at") <= then)) & (F.col("_until").isNull() | (then < F.col("_until")))
        return events.join(intervals, (F.col(key) == F.col("_key")) & inside, "left").select(*names, "_version.*")
    own = own.withColumn("_slice", _slice(F.col("_at"), hours))
    if open_start:
        first = F.col("_at") == F.min("_at").over(W.partitionBy("_key"))
        own = own.withColumn("_slice", F.when(~first, F.col("_slice"))).withColumn("_at", F.when(~first, F.col("_at")))
    no_version = F.lit(None).cast(dict(own.dtypes)["_version"]).alias("_version")
    placed = events.select(F.col(key).alias("_key"), F.col(at).cast("timestamp_ntz").alias("_at"), F.struct(*names).alias("_event"))
    known = F.col("_key").isNotNull() & F.col("_at").isNotNull()
    met = placed.where(known).withColumn("_slice", _slice(F.col("_at"), hours))

    # NULL times are those of versions that hold from the start; they sort first
    asked = met.select("_key", "_slice").distinct().select("_key", "_slice", F.lit(0).alias("_kind"), F.lit(None).cast("timestamp_ntz").alias("_at"), no_version)
    given = own.select("_key", "_slice", F.lit(1).alias("_kind"), "_at", "_version")
    before = W.partitionBy("_key").orderBy(F.asc_nulls_first("_slice"), "_kind", "_at").rowsBetween(W.unboundedPreceding, W.currentRow)
    carried = F.last("_version", ignorenulls=True)
    seeds = asked.unionByName(given).withColumn("_version", carried.over(before)).where("_kind = 0 AND _version IS NOT NULL")

    no_event = F.lit(None).cast(dict(met.dtypes)["_event"]).alias("_event")
    starts = seeds.unionByName(given.where("_slice IS NOT NULL")).select("_key", "_slice", F.lit(0).alias("_kind"), "_at", "_version", no_event)
    stream = starts.unionByName(met.select("_key", "_slice", F.lit(1).alias("_kind"), "_at", no_version, "_event"))
    upto = W.partitionBy("_key", "_slice").orderBy(F.asc_nulls_first("_at"), "_kind").rowsBetween(W.unboundedPreceding, W.currentRow)
    found = stream.withColumn("_version", carried.over(upto)).where("_kind = 1")
    rest = placed.where(~known).select("_event", no_version)
    return found.select("_event", "_version").unionByName(rest).select("_event.*", "_version.*")
