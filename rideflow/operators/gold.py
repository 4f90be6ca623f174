"""Star schema. Keys are hashes of the natural keys, so facts get them without joining."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rideflow.functions.keys import date_key, surrogate_key
from rideflow.functions.text import full_name
from rideflow.functions.times import is_weekend
from rideflow.operators.dedupe import flag_exactly
from rideflow.operators.history import as_of, scd2
from rideflow.sources.workdir import materialize, work_dir


def dim_customer(customers: DataFrame, *keep: str) -> DataFrame:
    return customers.select(surrogate_key("customer_id").alias("customer_key"),
                            full_name().alias("customer_name"), "city", "signup_date", *keep)


def dim_driver(drivers: DataFrame, *keep: str) -> DataFrame:
    return drivers.select(surrogate_key("driver_id").alias("driver_key"), full_name().alias("driver_name"),
                          "city", "vehicle_type", "rating", "join_date", *keep)


def dim_history(snapshots: DataFrame, entity: str, taken_on: str) -> DataFrame:
    """Versions of a dimension from its rows of several days (`taken_on`): the dimension's columns, `<entity>_version` (a key of its own, fixed by the
    dimension key and the first day), valid_from, valid_to (NULL while current), is_current."""
    key = f"{entity}_key"
    attrs = [c for c in snapshots.columns if c not in (key, taken_on)]
    versions = scd2(snapshots, key, attrs, taken_on)
    return versions.select(surrogate_key(key, "valid_from").alias(f"{entity}_version"), *versions.columns)


FEW_DAYS = 8


def with_version(fact: DataFrame, versions: DataFrame, entity: str, at: str) -> DataFrame:
    """`fact` with `<entity>_version`, the version that was valid at the time `at`. What lies before the first known day counts as its version.

    A version's key follows from the dimension key and its first day. So rows need no join where all their keys have one version and begin on the same day, as
    most dimension rows do, and none where versions begin on `FEW_DAYS` days at most, as after few deliveries: bitmaps tell on which of them
    the versions of a key begin (`flag_exactly`). Of longer histories, rows whose key has more versions, one of another day or none meet the versions
    by time. Keys are told apart each once; rows are not shuffled for it."""
    key, version, scratch = f"{entity}_key", f"{entity}_version", work_dir(fact.sparkSession)
    counted = versions.groupBy("valid_from").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "valid_from").limit(FEW_DAYS + 1).collect()
    once = F.lit(counted[0].valid_from if counted else None).cast("date")
    days = sorted(r.valid_from for r in counted)
    begins = [F.max(F.col("valid_from") == F.lit(day)).alias(f"_day_{i}") for i, day in enumerate(days[:FEW_DAYS])]
    known = versions.groupBy(F.col(key).alias("_known")).agg(F.count("*").alias("n"), F.min("valid_from").alias("since"), *begins)
    plain = F.coalesce((F.col("n") == 1) & (F.col("since") == once), F.lit(False))
    asked = fact.select(F.col(key).alias("_key")).filter("_key IS NOT NULL").distinct()
    found = asked.join(known, F.col("_key") == F.col("_known"), "left")
    keys = materialize(found.select("_key", (~plain).alias("_in"), *[F.coalesce(f"_day_{i}", F.lit(False)).alias(f"_day_{i}") for i in range(len(begins))]), f"{scratch}/keys")
    if version not in fact.columns and keys.filter("_in").isEmpty():
        return fact.withColumn(version, surrogate_key(key, once.alias("valid_from")))
    if version not in fact.columns and len(days) <= FEW_DAYS:
        flagged = fact
        for i in range(len(days)):
            flagged = flag_exactly(flagged, key, keys.select("_key", F.col(f"_day_{i}").alias("_in")), f"{scratch}/day_{i}", f"_begins_{i}")
        then = F.col(at).cast("timestamp_ntz")
        each = [(F.col(f"_begins_{i}"), F.lit(day)) for i, day in enumerate(days)]
        latest = [F.when(begin & (day.cast("timestamp_ntz") <= then), day) for begin, day in reversed(each)]
        first = [F.when(begin & then.isNotNull(), day) for begin, day in each]
        since = F.coalesce(*latest, *first, F.lit(None).cast("date"))
        return flagged.withColumn(version, surrogate_key(key, since)).drop(*[f"_begins_{i}" for i in range(len(days))])
    flagged = flag_exactly(fact, key, keys.select("_key", "_in"), scratch, "_varies")
    steady = flagged.filter(~F.col("_varies")).drop("_varies").withColumn(version, surrogate_key(key, once.alias("valid_from")))
    met = as_of(flagged.filter("_varies").drop("_varies"), versions, key, at, "valid_from", [version], open_start=True)
    return steady.unionByName(met)


def dim_location(rides: DataFrame) -> DataFrame:
    """Distinct city, area and cell of pickups and drop-offs. Each ride gives two places from one
    scan; duplicates are combined before the shuffle."""
    places = rides.select(F.explode(F.array(
        *[F.struct(F.col(f"{side}_city").alias("city"), F.col(f"{side}_area").alias("area"),
                   F.col(f"{side}_cell").alias("cell")) for side in ("pickup", "dropoff")])).alias("p"))
    return (places.select("p.*").distinct()
            .select(surrogate_key("city", "area", "cell").alias("location_key"), "city", "area", "cell"))


def dim_date(first, last, spark) -> DataFrame:
    """One row per day from `first` to `last` (dates or ISO text)."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("full_date"))
    return _date_columns(days)


def dim_date_of(*spans: tuple[DataFrame, str]) -> DataFrame:
    """The calendar that covers the given (frame, timestamp column) pairs."""
    bounds = None
    for df, ts in spans:
        one = df.agg(F.min(F.to_date(ts)).alias("lo"), F.max(F.to_date(ts)).alias("hi"))
        bounds = one if bounds is None else bounds.unionByName(one)
    limits = bounds.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).filter("lo IS NOT NULL")
    return _date_columns(limits.select(F.explode(F.sequence("lo", "hi")).alias("full_date")))


def _date_columns(days: DataFrame) -> DataFrame:
    return days.select(
        date_key(F.col("full_date")).alias("date_key"), "full_date",
        F.dayofmonth("full_date").alias("day"), F.month("full_date").alias("month"),
        F.quarter("full_date").alias("quarter"), F.year("full_date").alias("year"),
        F.dayofweek("full_date").alias("day_of_week"), is_weekend("full_date").alias("is_weekend"))


def fact_rides(rides: DataFrame, *keep: str) -> DataFrame:
    """Keys, times and measures; no raw id, name or coordinate."""
    return rides.select(
        surrogate_key("ride_id").alias("ride_key"),
        surrogate_key("customer_id").alias("customer_key"),
        surrogate_key("driver_id").alias("driver_key"),
        surrogate_key("pickup_city", "pickup_area", "pickup_cell").alias("location_key"),
        surrogate_key("dropoff_city", "dropoff_area", "dropoff_cell").alias("dropoff_location_key"),
        date_key(F.col("request_time")).alias("date_key"),
        "request_time", "pickup_time", "dropoff_time", F.hour("request_time").alias("ride_hour"),
        "distance_km", "fare", "surge_multiplier", "ride_status",
        F.year("request_time").alias("year"), F.month("request_time").alias("month"),
        *_lineage(rides), *keep)


def fact_payments(payments: DataFrame, *keep: str) -> DataFrame:
    return payments.select(
        surrogate_key("payment_id").alias("payment_key"),
        surrogate_key("ride_id").alias("ride_key"),
        surrogate_key("customer_id").alias("customer_key"),
        date_key(F.col("payment_time")).alias("date_key"),
        "amount", "tip_amount", "payment_method", "payment_status", "payment_time",
        F.year("payment_time").alias("year"), F.month("payment_time").alias("month"),
        *_lineage(payments), *keep)


def _lineage(df: DataFrame) -> list[str]:
    return [c for c in ("_source_file_uri", "_pipeline_run_id", "_processed_timestamp") if c in df.columns]


def key_bridge(df: DataFrame, natural: str, key: str) -> DataFrame:
    """Natural id to surrogate key; restricted, kept in Silver."""
    return df.select(natural, surrogate_key(natural).alias(key)).distinct()


def key_collisions(df: DataFrame, natural: str) -> DataFrame:
    """Surrogate keys shared by different natural keys (must be empty)."""
    pairs = df.select(surrogate_key(natural).alias("key"), natural).distinct()
    return pairs.groupBy("key").agg(F.count("*").alias("ids")).filter("ids > 1")


def star(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Left join of a fact to its dimensions: {key column: dimension}. Dimension columns get the
    key's prefix, e.g. driver_city. Spark broadcasts a dimension only while its size is under
    spark.sql.autoBroadcastJoinThreshold; a larger one is joined by shuffle, hot keys split."""
    out = fact
    for key, dim in dims.items():
        prefix = key.removesuffix("_key")
        renamed = dim.select(*[F.col(c) if c == key else F.col(c).alias(f"{prefix}_{c}") for c in dim.columns])
        out = out.join(renamed, key, "left")
    return out


def fk_violations(fact: DataFrame, keys: dict[str, DataFrame]) -> DataFrame:
    """Per fact key: distinct values without a dimension row, and the fact rows behind them.
    The fact is combined per key before the anti join."""
    result = None
    for key, dim in keys.items():
        missing = (fact.groupBy(key).agg(F.count("*").alias("rows"))
                   .join(dim.select(key), key, "left_anti")
                   .agg(F.count("*").alias("missing_keys"), F.coalesce(F.sum("rows"), F.lit(0)).alias("fact_rows"))
                   .select(F.lit(key).alias("key_name"), "missing_keys", "fact_rows"))
        result = missing if result is None else result.unionByName(missing)
    return result
