"""A ledger of files: what a job has read, so that every file is read once.

A file is known by its path, size and time together. Work is pending when the files that lie there differ from those written down, so files of
equal times, clocks that differ, and a second file beside one that was read are all told. A ledger has entries (a run, or a date of a
dataset); writing an entry again replaces it, so a job that is repeated counts once.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_FILE = ["file", "size", "modified"]


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """file, size, modified (microseconds) of the files under `path` that hold anything. They are listed, not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return found.select(F.regexp_replace("path", "^file:/+", "file:/").alias("file"), F.col("length").alias("size"),
                        F.unix_micros("modificationTime").alias("modified"))


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """entry, file, size, modified, files, list_hash of everything written down; no rows where there is no ledger yet."""
    try:
        return spark.read.parquet(ledger).withColumn("entry", F.col("entry").cast("string"))
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error) and "UNABLE_TO_INFER_SCHEMA" not in str(error):
            raise
        return spark.createDataFrame([], "file string, size long, modified long, files long, list_hash decimal(38,0), entry string")


def record(files: DataFrame, ledger: str) -> None:
    """Write down that `files` (as from `list_files`, with the `entry` each belongs to) have been read, in one job. They must have been listed before they
    were read: what came in between stays pending. Every row carries the number of files of its entry and the hash of their list."""
    files = files.select("entry", *_FILE)
    hashed = files.join(_list_hash(files, "entry"), "entry").repartition("entry")
    hashed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("entry").parquet(ledger)


def pending_files(files: DataFrame, recorded: DataFrame) -> DataFrame:
    """The files that no entry names with this size and time."""
    return files.join(recorded.select(*_FILE), _FILE, "left_anti")


def changed_groups(files: DataFrame, recorded: DataFrame, group: str) -> DataFrame:
    """The values of `group` whose files are not exactly those recorded for it. Groups without files are not pending: what was archived is done."""
    now, done = (_list_hash(df, group) for df in (files, recorded))
    done = done.select(group, F.col("files").alias("_files"), F.col("list_hash").alias("_hash"))
    return now.join(done, group, "left").filter("_hash IS NULL OR _hash <> list_hash OR _files <> files").select(group)


def _list_hash(files: DataFrame, *group: str) -> DataFrame:
    """Number of files and a hash of their list that does not depend on its order."""
    total = F.coalesce(F.sum(F.xxhash64(*_FILE).cast("decimal(28,0)")), F.lit(0)).cast("decimal(38,0)")
    return files.groupBy(*group).agg(F.count("*").alias("files"), total.alias("list_hash"))
