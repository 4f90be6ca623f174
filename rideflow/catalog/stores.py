"""Tables that several queries share: built once per session and data folder, then read from files."""

from __future__ import annotations

from collections.abc import Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rideflow import schemas
from rideflow.plans import lake, load
from rideflow.sources import testdata
from rideflow.sources.workdir import materialize, side_by_side, work_dir

SALT = "pepper-2024"
INGEST_DATE = "2026-10-08"

_built: dict[tuple[str, str, str], object] = {}


def _once(spark: SparkSession, sf_dir: str, kind: str, build):
    slot = (spark.sparkContext.applicationId, sf_dir, kind)
    if slot not in _built:
        _built[slot] = build(work_dir(spark))
    return _built[slot]


def _has(spark: SparkSession, sf_dir: str, kind: str) -> bool:
    return (spark.sparkContext.applicationId, sf_dir, kind) in _built


def staged(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The four datasets as stored tables, before any check."""
    def build(root):
        frames = testdata.tables(spark, sf_dir)
        return dict(zip(frames, side_by_side([partial(materialize, df, f"{root}/{name}") for name, df in frames.items()])))

    return _once(spark, sf_dir, "staged", build)


def raw(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The four datasets as text, as they are landed. Landing stores them, so they are not staged before."""
    return {name: testdata.as_text(df) for name, df in testdata.tables(spark, sf_dir).items()}


def evaluated(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The load profile's judged rows, all four datasets. Judging stores every row, so they are not staged before."""
    def build(root):
        frames = staged(spark, sf_dir) if _has(spark, sf_dir, "staged") else testdata.tables(spark, sf_dir)
        return load.evaluate_all(frames, stage_in=root)

    return _once(spark, sf_dir, "evaluated", build)


def lake_root(spark: SparkSession, sf_dir: str) -> str:
    """A lake built by the pipeline from the raw text form of the datasets."""
    def build(root):
        lake.land_all(raw(spark, sf_dir), root, INGEST_DATE)
        lake.run(spark, root, "run-1", "2026-10-08 12:00:00", SALT)
        return root

    return _once(spark, sf_dir, "lake", build)


HISTORY_DATES = ("1996-01-01", "1997-07-01", INGEST_DATE)


def snapshots(spark: SparkSession, sf_dir: str) -> dict[str, dict[str, DataFrame]]:
    """Customers and drivers as they were delivered on three days: cities and vehicles change, and some customers come later."""
    customers, drivers = testdata.customers(spark, sf_dir), testdata.drivers(spark, sf_dir)
    customer, driver = (F.substring(c, 2, 20).cast("bigint") for c in ("customer_id", "driver_id"))

    def moved(rest: int, city: str) -> DataFrame:
        return customers.withColumn("city", F.when(customer % 3 == rest, city).otherwise(F.col("city")))

    was = drivers.withColumn("vehicle_type", F.when(driver % 2 == 0, "SUV").otherwise(F.col("vehicle_type")))
    return dict(zip(HISTORY_DATES, ({"customers": moved(0, "Delhi").where(customer % 5 != 0), "drivers": was},
                                    {"customers": moved(1, "Pune"), "drivers": drivers}, {"customers": customers, "drivers": drivers}), strict=True))


def history_root(spark: SparkSession, sf_dir: str, facts: bool = True) -> str:
    """A lake with the snapshots of three days; rides and payments come on the last. Without `facts` they have not come yet: histories do not depend on them."""
    if not facts and _has(spark, sf_dir, "history"):
        facts = True

    def build(root):
        frames = testdata.tables(spark, sf_dir)
        for date, some in snapshots(spark, sf_dir).items():
            rest = {name: frames[name] for name in ("rides", "payments")} if facts and date == INGEST_DATE else {}
            lake.land_all({name: testdata.as_text(df) for name, df in (some | rest).items()}, root, date)
        lake.run(spark, root, "run-1", "2026-10-08 12:00:00", SALT)
        return root

    return _once(spark, sf_dir, "history" if facts else "history of entities", build)


class _Silver(Mapping):
    """Silver tables by name, built when they are asked for: a dataset is landed and processed after those it refers to, by the steps of the lake. A lake
    that was built as a whole is read instead."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __iter__(self):
        return iter(schemas.DATASETS)

    def __len__(self) -> int:
        return len(schemas.DATASETS)

    def __getitem__(self, dataset: str) -> DataFrame:
        spark, sf_dir = self.spark, self.sf_dir
        if _has(spark, sf_dir, "lake"):
            return lake.read_silver(spark, lake_root(spark, sf_dir), dataset)
        root = _once(spark, sf_dir, "silver", lambda new: new)

        def build(_folder):
            for parent in schemas.PARENTS[dataset]:
                self[parent]
            lake.land_all({dataset: raw(spark, sf_dir)[dataset]}, root, INGEST_DATE)
            lake.bronze_to_silver(spark, root, INGEST_DATE, "run-1", "2026-10-08 12:00:00", SALT, datasets=(dataset,))
            return root

        return lake.read_silver(spark, _once(spark, sf_dir, f"silver {dataset}", build), dataset)


def silver(spark: SparkSession, sf_dir: str) -> Mapping[str, DataFrame]:
    return _Silver(spark, sf_dir)


def gold(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return lake.gold_tables(spark, lake_root(spark, sf_dir))
