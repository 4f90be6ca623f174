"""Shared scratch space for tables that jobs write and read back."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession


def work_dir(spark: SparkSession) -> str:
    """A new folder under spark.checkpoint.dir, which every executor can reach.

    A machine-local folder is used only where the setting is absent and Spark runs in one process.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="rideflow-")
    return f"{base.rstrip('/')}/rideflow-{uuid.uuid4().hex}"


def materialize(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write `df` as a table and read it back: later plans start from files, which survive the loss
    of executors and let each of them read only its own columns."""
    writer = df.write.mode("overwrite").option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def side_by_side(jobs: Sequence[Callable[[], object]], at_once: int = 8) -> list:
    """Run independent Spark actions at the same time and return their results in order.
    Small jobs then fill the cluster together instead of one after the other."""
    if len(jobs) <= 1:
        return [job() for job in jobs]
    with ThreadPoolExecutor(max_workers=min(at_once, len(jobs))) as pool:
        return [future.result() for future in [pool.submit(job) for job in jobs]]
