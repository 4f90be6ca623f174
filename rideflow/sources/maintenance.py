"""Checks on what lies in the lake: integrity, inventory, pending work, retention."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rideflow.functions.keys import row_fingerprint

# Days until a partition is due, and what is due.
RETENTION_RULES = {"quarantine": (30, "expire"), "bronze": (90, "archive")}


def _file() -> Column:
    """The path as an encoded URI, with one slash after `file:`."""
    return F.regexp_replace("_metadata.file_path", "^file:/+", "file:/")


def _root_uri(spark: SparkSession, root: str) -> str:
    """`root` in the form of `_file`, with a slash at the end."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    full = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path)
    return re.sub("^file:/+", "file:/", full.toUri().toString()).rstrip("/") + "/"


def _file_sums(spark: SparkSession, roots: list[str]) -> DataFrame:
    """file, size, content of all files under `roots`; content covers bytes and order, and is NULL for an empty file.

    One scan reads all roots, so that files of equal size are split at equal places and a file of any size is spread over tasks.
    Of each split the line hashes are summed, plain and times the line's place, before anything is shuffled. Lines end
    at \\n alone, so a \\r is content. A single line is held whole in one task."""
    tree = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(roots)
    # a scan skips empty files; the listing, which the driver holds for the scan, names them as well
    names = spark.createDataFrame([(name,) for name in tree.inputFiles()], "name string")
    names = names.select(F.regexp_replace("name", "^file:/+", "file:/").alias("file"))
    sizes = tree.select(_file().alias("file"), F.col("_metadata.file_size").alias("size"))
    listed = names.join(sizes, "file", "left").select("file", F.coalesce("size", F.lit(0)).alias("size"))
    # the lower bits number the rows of a task one by one, and a split lies in one task
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    lines = (spark.read.option("recursiveFileLookup", True).option("lineSep", "\n").text(roots)
             .select(_file().alias("file"), F.col("_metadata.file_block_start").alias("block"),
                     place.cast("decimal(10,0)").alias("place"), F.xxhash64("value").alias("h")))
    short = F.col("h").bitwiseAND(F.lit((1 << 48) - 1)).cast("decimal(15,0)")
    blocks = lines.groupBy("file", "block").agg(
        F.count("*").alias("n"), F.sum(F.col("h").cast("decimal(20,0)")).alias("plain"), F.sum(short).alias("short"),
        F.sum(short * F.col("place")).alias("placed"), F.min("place").alias("least"))
    ordered = F.col("placed") - F.col("least") * F.col("short").cast("decimal(25,0)")
    block_sum = F.xxhash64("block", "n", F.col("plain").cast("string"), ordered.cast("string"))
    content = blocks.groupBy("file").agg(F.sum(block_sum.cast("decimal(20,0)")).alias("content"))
    return listed.join(content, "file", "left")


def verify_landing(spark: SparkSession, source: str, landed: str) -> DataFrame:
    """Compare two file trees, neither inside the other, by relative path: one row per file with `status` ok, missing,
    extra, size_mismatch or checksum_mismatch. The rule is the same for files of every size."""
    uris = {root: _root_uri(spark, root) for root in (source, landed)}
    files = _file_sums(spark, sorted({uri: root for root, uri in uris.items()}.values()))

    def side(root: str) -> DataFrame:
        # a plus sign in a path stands for itself
        rel = F.url_decode(F.replace(F.substring("file", len(uris[root]) + 1, 1 << 20), F.lit("+"), F.lit("%2B")))
        return files.filter(F.startswith("file", F.lit(uris[root]))).select(rel.alias("rel"), "size", "content")

    s, d = side(source).alias("s"), side(landed).alias("d")
    status = (F.when(F.col("d.size").isNull(), "missing")
              .when(F.col("s.size").isNull(), "extra")
              .when(F.col("s.size") != F.col("d.size"), "size_mismatch")
              .when(~F.col("s.content").eqNullSafe(F.col("d.content")), "checksum_mismatch")
              .otherwise("ok"))
    return s.join(d, F.col("s.rel") == F.col("d.rel"), "full_outer").select(
        F.coalesce("s.rel", "d.rel").alias("file"), F.col("s.size").alias("source_bytes"),
        F.col("d.size").alias("landed_bytes"), status.alias("status"))


def table_fingerprint(df: DataFrame) -> DataFrame:
    """Row count and an order-free content hash, in one aggregation."""
    return df.agg(F.count("*").alias("rows"),
                  F.coalesce(F.sum(row_fingerprint(df.columns).cast("decimal(38,0)")), F.lit(0)).alias("content"))


def verify_rows(source: DataFrame, landed: DataFrame) -> DataFrame:
    """One row: do both frames hold the same rows, in any order and file layout?"""
    a = table_fingerprint(source).select(F.lit(1).alias("k"), F.col("rows").alias("source_rows"), F.col("content").alias("a"))
    b = table_fingerprint(landed.select(*source.columns)).select(F.lit(1).alias("k"), F.col("rows").alias("landed_rows"), F.col("content").alias("b"))
    return a.join(b, "k").select("source_rows", "landed_rows",
                                 ((F.col("source_rows") == F.col("landed_rows")) & (F.col("a") == F.col("b"))).alias("identical"))


def pending_partitions(landed: DataFrame, processed: DataFrame, keys: list[str]) -> DataFrame:
    """Partitions present in `landed` that `processed` does not list."""
    return landed.select(*keys).distinct().join(processed.select(*keys).distinct(), keys, "left_anti")


def partition_values(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """Distinct partition values under `path`, as text. Only file names are listed; no file is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path")
    return files.select(*[F.regexp_extract("path", f"/{n}=([^/]+)/", 1).alias(n) for n in names]).distinct()


def retention_candidates(partitions: DataFrame, run_date: str, rules: dict = RETENTION_RULES) -> DataFrame:
    """(layer, dataset, partition_date) rows older than their layer's limit, with the action that
    is due. Nothing is deleted."""
    age = F.date_diff(F.lit(run_date).cast("date"), F.col("partition_date"))
    action = F.lit(None).cast("string")
    for layer, (days, what) in rules.items():
        action = F.when((F.col("layer") == layer) & (age > days), F.lit(what)).otherwise(action)
    return (partitions.withColumn("age_days", age).withColumn("action", action).filter("action IS NOT NULL"))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Labelled counts, one row per table."""
    result = None
    for name, df in tables.items():
        one = df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        result = one if result is None else result.unionByName(one)
    return result


def table_info(spark: SparkSession, names: list[str] | None = None) -> DataFrame:
    """Columns, types and nullability of the catalog's tables and views."""
    found = [t.name for t in spark.catalog.listTables() if names is None or t.name in names]
    rows = [(t, c.name, c.dataType, bool(c.nullable)) for t in sorted(found) for c in spark.catalog.listColumns(t)]
    return spark.createDataFrame(rows, "table_name string, column_name string, data_type string, nullable boolean")


def table_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Tables created between two inventories, and those that existed already."""
    old, new = before.select("table_name"), after.select("table_name")
    created = new.subtract(old).withColumn("state", F.lit("created"))
    return created.unionByName(new.intersect(old).withColumn("state", F.lit("existing")))
