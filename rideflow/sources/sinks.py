"""Writers. All overwrite what the same run wrote before, so a rerun changes nothing."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rideflow.sources.workdir import materialize, work_dir


def write_csv(df: DataFrame, path: str, line_breaks: bool = False) -> None:
    """Header, NULL as an empty field, the empty string quoted, quotes doubled, blanks kept.

    A value with a line break fails the write, because readers that split files would tear its row; with
    `line_breaks` it is written, for readers that do not."""
    _csv_writer(df, line_breaks).csv(path)


def _csv_writer(df: DataFrame, line_breaks: bool = False) -> DataFrameWriter:
    if not line_breaks:
        df = df.select([_one_line(f.name) if f.dataType == T.StringType() else F.col(f"`{f.name}`") for f in df.schema])
    return (df.write.mode("overwrite").option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]")
            .option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))


def _one_line(name: str) -> Column:
    value = F.col(f"`{name}`")
    torn = F.raise_error(F.lit(f"a value of {name} holds a line break")).cast("string")
    return F.when(F.contains(value, F.lit("\n")) | F.contains(value, F.lit("\r")), torn).otherwise(value).alias(name)


def write_json(df: DataFrame, path: str) -> None:
    """One record per line, ISO-8601 dates and times, NULL fields kept."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_json_arrays(df: DataFrame, path: str) -> None:
    """JSON arrays of records, one of each input partition under `{path}/array=N/`, with the fields of `write_json`.

    A frame without rows writes no array. `read_json_splits` reads them from `path`, `read_json` from `{path}/*`."""
    place, last = F.col("_n").bitwiseAND(F.lit((1 << 33) - 1)), F.lead("_n").over(Window.partitionBy("array").orderBy("_n")).isNull()
    rows = df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("_row"), F.monotonically_increasing_id().alias("_n"))
    dealt = rows.withColumn("array", F.shiftright("_n", 33))
    lines = dealt.select("array", F.concat(F.when(place == 0, "[").otherwise(","), "_row", F.when(last, "]").otherwise("")).alias("value"))
    lines.write.mode("overwrite").partitionBy("array").text(path)


def iso_date(value: str) -> dt.date:
    """`YYYY-MM-DD` or an error."""
    if len(value) != 10:
        raise ValueError(f"date must be YYYY-MM-DD, got {value!r}")
    return dt.datetime.strptime(value, "%Y-%m-%d").date()


def bronze_path(root: str, dataset: str, run_date: str) -> str:
    d = iso_date(run_date)
    return f"{root}/bronze/{dataset}/year={d.year}/month={d.month:02d}/day={d.day:02d}"


def land_bronze(df: DataFrame, root: str, dataset: str, run_date: str) -> str:
    """Write the rows as they are (text) into the partition of `run_date`, replacing it.
    A past date is a backfill; other partitions are not touched."""
    path = bronze_path(root, dataset, run_date)
    text = df.select([F.col(c).cast("string").alias(c) for c in df.columns])
    _bronze_writer(text).csv(path)
    return path


def _bronze_writer(df: DataFrame) -> DataFrameWriter:
    """CSV packed by gzip, a third of the bytes, at level 3: a sixth more than at the usual level, in less time. A packed file is read by one task, so files
    hold a million rows at most."""
    return _csv_writer(df).option("compression", "gzip").option("zlib.compress.level", "THREE").option("maxRecordsPerFile", 1_000_000)


def write_partitioned(df: DataFrame, path: str, cols: list[str], sort: list[str] | None = None,
                      max_records_per_file: int = 0) -> None:
    """Parquet by partition columns; only partitions present in `df` are replaced.

    REBALANCE gathers each partition's rows so that files are few, and lets Spark split a partition
    that is much larger than spark.sql.adaptive.advisoryPartitionSizeInBytes over several tasks."""
    out = df.hint("rebalance", *cols)
    if sort:
        out = out.sortWithinPartitions(*cols, *sort)
    writer = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*cols)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.parquet(path)


def bytes_per_row(df: DataFrame, rows: int, sample_rows: int = 1_000_000) -> float:
    """Parquet bytes a row takes, measured on a stored sample of about `sample_rows` of the `rows` rows (all, where there are fewer)."""
    spark, path = df.sparkSession, work_dir(df.sparkSession)
    some = df if rows <= sample_rows else df.sample(sample_rows / rows, seed=1)
    # few files, as footers and dictionaries of many small ones would count as rows
    some.repartition(max(1, min(rows, sample_rows) // 250_000)).write.parquet(path)
    stored = spark.read.parquet(path).count()
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return (listed.agg(F.sum("length")).first()[0] or 0) / max(stored, 1)


def write_sized(df: DataFrame, path: str, cols: list[str], sort: list[str] | None = None, target_bytes: int = 128 << 20,
                sample_rows: int = 1_000_000) -> None:
    """Parquet by partition columns in files of about half the target to the target; only partitions present in `df` are replaced. A partition
    that holds less is one file.

    Bytes a row come from a stored sample and rows a partition from a count, so `df` is read three times: store it first. A partition's rows are
    dealt to its files by hash and input partition, so one that holds most rows is written by many tasks."""
    counts = materialize(df.groupBy(*cols).agg(F.count("*").alias("_rows")), work_dir(df.sparkSession))
    total = counts.agg(F.sum("_rows")).first()[0] or 0
    per_file = max(1, int(target_bytes / max(bytes_per_row(df, total, sample_rows), 1e-9)))
    # the files are numbered through, so that each is the whole of one task; one row a partition
    before = Window.orderBy(*cols).rowsBetween(Window.unboundedPreceding, -1)
    needed = counts.withColumn("_files", F.ceil(F.col("_rows") / per_file))
    numbered = needed.withColumn("_first", F.coalesce(F.sum("_files").over(before), F.lit(0)))
    files = materialize(numbered.select(*[F.col(c).alias(f"_{c}_") for c in cols], "_files", "_first"), work_dir(df.sparkSession))
    tasks = files.agg(F.sum("_files")).first()[0] or 1
    same = [F.col(c).eqNullSafe(F.col(f"_{c}_")) for c in cols]
    dealt = df.withColumn("_from", F.spark_partition_id()).join(files, same)
    file = F.col("_first") + F.pmod(F.xxhash64(*df.columns, "_from"), F.col("_files"))
    out = dealt.repartitionById(tasks, file.cast("int")).sortWithinPartitions(*cols, *(sort or [])).select(*df.columns)
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*cols).parquet(path)


def write_date(df: DataFrame, base: str, date: str, cols: tuple[str, ...] = ()) -> None:
    """Replace `{base}/ingest_date={date}` as a whole, even when a rerun yields fewer sub-partitions
    or no rows. Without sub-partitions every task writes one file of what it read, and no row is shuffled."""
    iso_date(date)
    out = df.hint("rebalance", *cols) if cols else df
    writer = out.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", "zstd")
    if cols:
        writer = writer.partitionBy(*cols)
    writer.parquet(f"{base}/ingest_date={date}")


def _files_of(spark: SparkSession, folders: list[str]) -> set[str]:
    """Paths of the part files in folders that may be missing."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    there = [f for f in folders if hadoop(f).getFileSystem(conf).exists(hadoop(f))]
    if not there:
        return set()
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "part-*").load(there)
    return {r.path for r in found.select("path").collect()}


def _replace_folders(writer: DataFrameWriter, base: str, parts: list[str], folders: list[str], spark: SparkSession, fmt: str) -> set[str]:
    """Write partitions by `parts` below `base` in one job, and delete what the folders held besides. Returns the new files."""
    before = _files_of(spark, folders)
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(*parts).format(fmt).save(base)
    after = _files_of(spark, folders)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for stale in before & after:  # a replaced partition has files of other names
        path = hadoop(stale)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, False)
    return after - before


def write_dates(df: DataFrame, base: str, dates: list[str], cols: tuple[str, ...] = (), date_col: str = "ingest_date") -> None:
    """Replace the given dates (`{base}/{date_col}=`) as a whole in one job; `df` holds the date and rows of these dates only. It may read what it
    replaces: the rows are written aside in that job, and dates are replaced when all are. Other dates are not touched. Sub-partitions and dates that `df` has no rows for are emptied afterwards."""
    # one date without sub-partitions is one folder: its rows are written where they are
    gathered = df.hint("rebalance", date_col, *cols) if cols or len(dates) > 1 else df
    writer = gathered.write.mode("overwrite").option("compression", "zstd")
    new = _replace_folders(writer, base, [date_col, *cols], [f"{base}/{date_col}={d}" for d in dates], df.sparkSession, "parquet")
    filled = {d for d in dates if any(f"/{date_col}={d}/" in f for f in new)}
    for date in () if cols else set(dates) - filled:  # an empty file keeps an empty date known
        df.drop(date_col).limit(0).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{base}/{date_col}={date}")


def land_dates(df: DataFrame, root: str, dataset: str, dates: list[str]) -> None:
    """Replace the Bronze partitions of the given dates in one job; `df` holds text, with year, month and day, and may read what it replaces, as in `write_dates`."""
    parts = ["year", "month", "day"]
    writer = _bronze_writer(df.hint("rebalance", *parts) if len(dates) > 1 else df)
    _replace_folders(writer, f"{root}/bronze/{dataset}", parts, [bronze_path(root, dataset, d) for d in dates], df.sparkSession, "csv")


def save_clustered(df: DataFrame, path: str, key: str, sort: str, files: int | None = None) -> None:
    """Cluster a fact by join key and time.

    Ranges of (key, sort) instead of hash buckets: file statistics prune on both columns, and a key
    that holds a large part of the rows is spread over several files by its time."""
    ranged = df.repartitionByRange(files, key, sort) if files else df.repartitionByRange(key, sort)
    ranged.sortWithinPartitions(key, sort).write.mode("overwrite").parquet(path)


def audit_log(spark: SparkSession, root: str, run_id: str, logged_at: str,
              events: list[tuple[str, str, int, int]]) -> None:
    """Record (event, dataset, rows, bytes) of one run under `dt=/run_id=`; a rerun replaces its own
    records. A run has a handful of events."""
    rows = spark.createDataFrame(events, "event string, dataset string, rows long, bytes long")
    (rows.withColumn("logged_at", F.lit(logged_at).cast("timestamp_ntz"))
     .withColumn("dt", F.lit(logged_at[:10])).withColumn("run_id", F.lit(run_id))
     .coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("dt", "run_id").parquet(f"{root}/audit"))


def run_id(layer: str, started: dt.datetime, suffix: str) -> str:
    """`bronze-20260825-103000-0a1b2c3d`; the parts are arguments so that reruns are comparable."""
    return f"{layer}-{started:%Y%m%d-%H%M%S}-{suffix}"
