"""Stage, validate and load the four datasets in foreign-key order, against accepted parents only."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rideflow import schemas
from rideflow.operators import quality
from rideflow.sources.workdir import materialize, side_by_side, work_dir


def rules_for(dataset: str, profile: str):
    if profile == "load":
        return quality.LOAD_RULES[dataset]
    if profile == "silver":
        return quality.silver_rules(dataset)
    raise ValueError(f"unknown profile {profile}")


def typed(df: DataFrame) -> DataFrame:
    """is_active is TRUE only for exactly 'True'."""
    if dict(df.dtypes).get("is_active") == "string":
        return df.withColumn("is_active", F.coalesce(F.col("is_active") == "True", F.lit(False)))
    return df


def evaluate_all(frames: dict[str, DataFrame], profile: str = "load", primary_keys: bool = True,
                 stage_in: str | None = None) -> dict[str, DataFrame]:
    """Evaluated frames per dataset, parents first. With `stage_in` the verdicts are stored there, so
    children check against stored tables and nothing is judged twice."""
    evaluated: dict[str, DataFrame] = {}
    parents: dict[str, DataFrame] = {}

    def one(dataset: str) -> DataFrame:
        unique = [u for u in quality.unique_rules(dataset) if primary_keys or u.code != "DUPLICATE_PK"]
        args = (typed(frames[dataset]), rules_for(dataset, profile), quality.foreign_keys(dataset, parents, unique=primary_keys), unique)
        return quality.judge(*args, stage_in=f"{stage_in}/{dataset}") if stage_in else quality.evaluate(*args)

    for level in schemas.LEVELS:
        for dataset, frame in zip(level, side_by_side([partial(one, dataset) for dataset in level])):
            evaluated[dataset] = frame
            parents[dataset] = quality.accepted(frame)
    return evaluated


def reports(evaluated: dict[str, DataFrame], profile: str = "load") -> DataFrame:
    """One report row per table."""
    result = None
    for dataset, frame in evaluated.items():
        one = quality.load_report(frame, dataset, rules_for(dataset, profile),
                                  quality.foreign_keys(dataset, evaluated), quality.unique_rules(dataset))
        result = one if result is None else result.unionByName(one)
    return result


def load_all(frames: dict[str, DataFrame], root: str, run_id: str = "load", loaded_at: str = "1970-01-01 00:00:00",
             profile: str = "load") -> DataFrame:
    """Replace the four tables under `root` and the run's quarantine, and return the report.

    All tables are staged and judged first; only then is anything replaced, so a failure on the way
    leaves the old tables in place."""
    spark = next(iter(frames.values())).sparkSession
    scratch = work_dir(spark)
    staged = evaluate_all(frames, profile, stage_in=scratch)

    def publish(name: str) -> None:
        quality.accepted(staged[name]).write.mode("overwrite").parquet(f"{root}/{name}")

    def keep_rejected(name: str) -> None:
        bad = quality.quarantine(staged[name], f"{root}/{name}", run_id, loaded_at)
        (bad.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dt")
         .parquet(f"{root}/quarantine/{name}"))

    def report() -> DataFrame:
        return materialize(reports(staged, profile), f"{scratch}/report")

    writes = [partial(write, name) for write in (publish, keep_rejected) for name in staged]
    return side_by_side([report, *writes], at_once=9)[0]


# The reason names the loader prints, as row predicates over a dataset and its loaded parents.
LEGACY_REASONS = {
    "customers": {},
    "drivers": {
        "invalid_vehicle_type": f"vehicle_type NOT IN {schemas.VEHICLE_TYPES}",
        "invalid_rating": "rating < 1.0 OR rating > 5.0",
    },
    "rides": {
        "negative_distance": "distance_km < 0",
        "negative_fare": "fare < 0",
        "zero_fare": "fare = 0 AND ride_status = 'completed'",
        "invalid_surge": "surge_multiplier < 1.0",
        "invalid_status": f"ride_status NOT IN {schemas.RIDE_STATUSES}",
    },
    "payments": {
        "negative_amount": "amount < 0",
        "negative_tip": "tip_amount < 0",
        "invalid_method": f"payment_method NOT IN {schemas.PAYMENT_METHODS}",
        "invalid_status": f"payment_status NOT IN {schemas.PAYMENT_STATUSES}",
    },
}

_LEGACY_PARENTS = {
    "rides": {"orphan_customer": ("customer_id", "customers"), "orphan_driver": ("driver_id", "drivers")},
    "payments": {"orphan_ride": ("ride_id", "rides"), "orphan_customer": ("customer_id", "customers")},
}

_LEGACY_DUPLICATES = {"customers": ("duplicate_email", "email"), "drivers": ("duplicate_license", "license_number")}


def legacy_reasons(frames: dict[str, DataFrame], loaded: dict[str, DataFrame], dataset: str) -> DataFrame:
    """Reason counts as the loader prints them: UNKNOWN counts as no, a missing foreign key is not an
    orphan, and every row of a duplicated key is counted, the kept one too."""
    from rideflow.operators.dedupe import duplicated_keys
    from rideflow.operators.reconcile import orphan_keys

    df = frames[dataset]
    result = None

    def add(frame):
        nonlocal result
        result = frame if result is None else result.unionByName(frame)

    reasons = LEGACY_REASONS[dataset]
    if reasons:
        wide = df.agg(*[F.count_if(F.expr(p)).alias(name) for name, p in reasons.items()])
        add(wide.unpivot([], list(reasons), "reason", "rows"))
    if dataset in _LEGACY_DUPLICATES:
        name, key = _LEGACY_DUPLICATES[dataset]
        dup = duplicated_keys(df.filter(F.col(key).isNotNull()), [key])
        add(dup.agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("rows")).select(F.lit(name).alias("reason"), "rows"))
    for name, (key, parent) in _LEGACY_PARENTS.get(dataset, {}).items():
        lost = orphan_keys(df, key, loaded[parent], key)
        add(lost.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")).select(F.lit(name).alias("reason"), "rows"))
    return result.select(F.lit(dataset).alias("table_name"), "reason", "rows").filter("rows > 0")
