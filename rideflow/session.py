"""Session settings the plans rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Initial shuffle partitions are many on a cluster: adaptive execution merges small ones, but it cannot
# split a hash partition of an aggregation.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Accepted and rejected rows go to two directories; with a few open files per task they need no sort.
    "spark.sql.maxConcurrentOutputFileWriters": "4",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "snappy",
}


def build_session(app: str = "rideflow", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with the settings above. Give `shuffle_partitions` the number of cores on one
    machine, and two to four times the number of executor cores on a cluster."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()
