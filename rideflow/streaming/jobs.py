"""Streaming jobs: files in, Parquet out, every sink idempotent per micro-batch.

A production stream differs in the source only; the jobs take any streaming DataFrame.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rideflow.functions.times import utc_instant, utc_wall_clock
from rideflow.operators import quality
from rideflow.operators.dedupe import latest_per_key
from rideflow.operators.history import as_of
from rideflow.sources.readers import CSV_OPTIONS
from rideflow.sources.workdir import work_dir
from rideflow.streaming import state


def file_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """Files that appear under `path` (a folder or glob)."""
    reader = spark.readStream.schema(schema)
    if fmt == "csv":
        reader = reader.options(**CSV_OPTIONS)
    return reader.format(fmt).load(path)


def event_time(df: DataFrame, column: str = "ts") -> DataFrame:
    """Watermarks need TIMESTAMP; files carry times without a zone, which count as UTC."""
    return df if dict(df.dtypes)[column] == "timestamp" else df.withColumn(column, utc_instant(column))


def run_available_now(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Process everything that has arrived into a Parquet table, then stop."""
    (df.writeStream.format("parquet").outputMode(mode).option("path", path)
     .option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination())


def run_batches(df: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    """Call `handle(batch, batch_id)` for everything that has arrived, then stop."""
    (df.writeStream.foreachBatch(handle).outputMode(mode).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())


def dedupe_events(stream: DataFrame, key: str = "event_id", ts: str = "ts", delay: str = "10 minutes") -> DataFrame:
    """An event delivered again within the watermark delay counts once. State expires with the watermark."""
    return event_time(stream, ts).withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def hourly_demand(stream: DataFrame, group: str = "event_type", ts: str = "ts", delay: str = "10 minutes") -> DataFrame:
    """Events per hour and group; a window is emitted once the watermark has passed its end."""
    windows = (event_time(stream, ts).withWatermark(ts, delay)
               .groupBy(F.window(ts, "1 hour").alias("w"), group)
               .agg(F.count("*").alias("events"), F.sum(F.col("value").cast("decimal(12,2)")).alias("value")))
    return windows.select(utc_wall_clock("w.start").alias("window_start"), utc_wall_clock("w.end").alias("window_end"), group, "events",
                          F.col("value").cast("decimal(18,2)").alias("value"))


def demand_upserts(stream: DataFrame, out: str, checkpoint: str, group: str = "event_type", ts: str = "ts", delay: str = "10 minutes",
                   parts: int = state.PARTS) -> None:
    """Hourly demand of everything that has arrived, open windows included, as a state at `out` with one row per window and group. Every batch sends
    the windows it changed with their totals so far, and they replace the rows stored before. An event counts if it is not older than
    the newest event before its batch by more than the delay."""
    run_batches(hourly_demand(stream, group, ts, delay), state.upsert_state(out, ["window_start", group], [], parts), checkpoint, "update")


def enrich(stream: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Stream-static left join. The dimension is broadcast while it is under Spark's size limit."""
    return stream.join(dimension, key, "left")


def enrich_as_of(out: str, versions: Callable[[], DataFrame], key: str, ts: str, valid_from: str, carry: list[str],
                 open_start: bool = False) -> Callable[[DataFrame, int], None]:
    """Batch handler that gives every event the version that was valid at its time, however late it arrives. `versions()` is called per batch, so
    it sees the history as of then; replaying a batch replaces its own output."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        as_of(batch, versions(), key, ts, valid_from, carry, open_start).write.mode("overwrite").parquet(_batch_path(out, batch_id))

    return handle


def _batch_path(root: str, batch_id: int) -> str:
    return f"{root}/batch_id={batch_id}"


def _read_batches(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    full = T.StructType(list(schema) + [T.StructField("batch_id", T.LongType())])
    return spark.read.schema(full).option("basePath", root).parquet(f"{root}/batch_id=*")


def route_late(out: str, ts: str = "ts", delay_seconds: int = 600) -> Callable[[DataFrame, int], None]:
    """Batch handler that loses nothing: an event is late when it is older than the newest event of
    all earlier batches by more than the delay. On-time and late events go to `late=false` and
    `late=true` of one table. Replaying a batch replaces its own output."""
    progress_schema = T.StructType([T.StructField("newest", T.TimestampNTZType())])

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        newest = None
        if batch_id > 0:
            newest = spark.read.schema(progress_schema).parquet(_batch_path(f"{out}/progress", batch_id - 1)).first()[0]
        limit = F.lit(None if newest is None else str(newest)).cast("timestamp_ntz") - F.make_dt_interval(secs=F.lit(delay_seconds))
        late = F.coalesce(F.col(ts) < limit, F.lit(False))
        (batch.withColumn("late", late).write.mode("overwrite").partitionBy("late")
         .parquet(_batch_path(f"{out}/events", batch_id)))
        # the newest of all batches so far, so that the next one reads this row only
        so_far = F.greatest(F.max(ts).cast("timestamp_ntz"), F.lit(None if newest is None else str(newest)).cast("timestamp_ntz"))
        batch.agg(so_far.alias("newest")).write.mode("overwrite").parquet(_batch_path(f"{out}/progress", batch_id))

    return handle


def split_batches(out: str, clean: Callable[[DataFrame], DataFrame], rules, foreign=lambda: (), unique=()) -> Callable[[DataFrame, int], None]:
    """Batch handler for Bronze -> Silver: the batch operators on each micro-batch, written once
    under `ok=true` (accepted) and `ok=false` (quarantine). `foreign()` is called per batch, so it
    sees the parents loaded by then."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        judged = quality.judge(clean(batch), rules, foreign(), unique, stage_in=work_dir(batch.sparkSession)).drop("_ok")
        (judged.withColumn("ok", F.size("failures") == 0).write.mode("overwrite").partitionBy("ok")
         .parquet(_batch_path(out, batch_id)))

    return handle


def upsert_log(out: str, key: str, order: str) -> Callable[[DataFrame, int], None]:
    """Batch handler that appends the newest row per key of each batch to a change log. Work per
    batch follows the batch, not the size of the state."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        latest_per_key(batch, [key], [order]).write.mode("overwrite").parquet(_batch_path(out, batch_id))

    return handle


def current_state(spark: SparkSession, out: str, schema: T.StructType, key: str, order: str) -> DataFrame:
    """The newest row per key over the change log."""
    log = _read_batches(spark, out, schema)
    return latest_per_key(log, [key], [order, "batch_id"]).drop("batch_id")


def compact_state(spark: SparkSession, out: str, schema: T.StructType, key: str, order: str, target: str) -> None:
    """Store the current state as the base of a new log at `target`. The base is numbered before batch 0, so no
    batch of a later stream overwrites it."""
    current_state(spark, out, schema, key, order).write.mode("overwrite").parquet(_batch_path(target, -1))
