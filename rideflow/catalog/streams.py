"""Streaming queries: the event files are streamed, and the stored result is read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from rideflow import schemas
from rideflow.catalog import stores
from rideflow.catalog.accepted_sql import accepted
from rideflow.catalog.mapping_sql import with_tables
from rideflow.catalog.registry import query
from rideflow.functions.times import utc_wall_clock
from rideflow.operators import quality
from rideflow.operators import silver as steps
from rideflow.sources import sinks
from rideflow.sources.testdata import as_text, payments, ride_events
from rideflow.sources.workdir import work_dir
from rideflow.streaming import jobs, state

# Events of this type arrive one run after the others, whatever their time.
_TARDY = "event_type = 'signup'"
_WINDOWS = "window_start timestamp_ntz, window_end timestamp_ntz, event_type string, events long, value decimal(18,2)"


def _event_stream(spark, d):
    return jobs.file_stream(spark, f"{d}/events*.parquet", schemas.EVENTS)


def _arrivals(spark, d, handle, root):
    """Deliver the events in two runs of one stream: first the punctual ones, then the tardy ones."""
    for condition in (f"NOT ({_TARDY})", _TARDY):
        ride_events(spark, d).filter(condition).write.mode("append").parquet(f"{root}/in")
        jobs.run_batches(jobs.file_stream(spark, f"{root}/in", schemas.EVENTS), handle, f"{root}/checkpoint")


@query("st_01_file_stream", """
SELECT event_id, ts, user_id, event_type, value::DECIMAL(12,2) AS value FROM events""")
def _(spark, d):
    root = work_dir(spark)
    rows = _event_stream(spark, d).select("event_id", "ts", "user_id", "event_type", F.col("value").cast("decimal(12,2)").alias("value"))
    jobs.run_available_now(rows, f"{root}/out", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/out")


@query("st_02_late_data", f"""
WITH newest AS (SELECT max(ts) AS t FROM events WHERE NOT ({_TARDY}))
SELECT event_type, {_TARDY} AND ts < (SELECT t FROM newest) - INTERVAL 10 MINUTE AS late, count(*) AS events, count(DISTINCT event_id) AS ids
FROM events GROUP BY 1, 2""")
def _(spark, d):
    root = work_dir(spark)
    _arrivals(spark, d, jobs.route_late(f"{root}/out"), root)
    routed = spark.read.option("basePath", f"{root}/out/events").parquet(f"{root}/out/events/batch_id=*")
    return (routed.groupBy("event_type", F.col("late").cast("boolean").alias("late"), "event_id").agg(F.count("*").alias("n"))
            .groupBy("event_type", "late").agg(F.sum("n").alias("events"), F.count("*").alias("ids")))


@query("st_03_dedupe", "SELECT event_id, ts, user_id, event_type FROM events")
def _(spark, d):
    root = work_dir(spark)
    twice = _event_stream(spark, d).select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("delivery")).drop("delivery")
    once = jobs.dedupe_events(twice).select("event_id", utc_wall_clock("ts").alias("ts"), "user_id", "event_type")
    jobs.run_available_now(once, f"{root}/out", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/out")


@query("st_04_hourly_demand", """
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, event_type, events, value FROM (
  SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS events, sum(value::DECIMAL(12,2))::DECIMAL(18,2) AS value
  FROM events GROUP BY 1, 2)
WHERE window_start + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE""")
def _(spark, d):
    root = work_dir(spark)
    jobs.run_available_now(jobs.hourly_demand(_event_stream(spark, d)), f"{root}/out", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/out")


# The punctual events come first, so the tardy ones reach windows that are stored already; the delay covers them all.
@query("st_04_demand_upserts", """
SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, event_type, count(*) AS events,
  sum(value::DECIMAL(12,2))::DECIMAL(18,2) AS value
FROM events GROUP BY 1, 2, 3""")
def _(spark, d):
    root = work_dir(spark)
    for condition in (f"NOT ({_TARDY})", _TARDY):
        ride_events(spark, d).filter(condition).write.mode("append").parquet(f"{root}/in")
        jobs.demand_upserts(jobs.file_stream(spark, f"{root}/in", schemas.EVENTS), f"{root}/out", f"{root}/checkpoint", delay="400 days")
    return state.read_state(spark, f"{root}/out", _WINDOWS)


@query("st_05_bronze_to_silver", accepted("""
SELECT payment_id, amount >= 0 AND payment_id IN (SELECT payment_id FROM payments_ok) AS ok FROM payments"""))
def _(spark, d):
    root = work_dir(spark)
    sinks.write_csv(as_text(payments(spark, d)), f"{root}/in")
    parents = {n: quality.accepted(df) for n, df in stores.evaluated(spark, d).items()}
    handle = jobs.split_batches(
        f"{root}/out", lambda batch: steps.clean(batch, "payments"), quality.LOAD_RULES["payments"],
        lambda: quality.foreign_keys("payments", parents, unique=True), quality.unique_rules("payments"))
    stream = jobs.file_stream(spark, f"{root}/in", schemas.as_text(schemas.PAYMENTS), "csv")
    jobs.run_batches(stream, handle, f"{root}/checkpoint")
    stored = spark.read.option("basePath", f"{root}/out").parquet(f"{root}/out/batch_id=*")
    return stored.select("payment_id", F.col("ok").cast("boolean").alias("ok"))


@query("st_06_upsert_state", """
SELECT user_id, event_id, ts, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def _(spark, d):
    root = work_dir(spark)
    _arrivals(spark, d, jobs.upsert_log(f"{root}/out", "user_id", "ts"), root)
    return (jobs.current_state(spark, f"{root}/out", schemas.EVENTS, "user_id", "ts")
            .select("user_id", "event_id", "ts", "event_type"))


# The second batch fails once between its two writes and is delivered again in whole; the first is delivered again after it.
@query("st_06_bounded_state", """
SELECT user_id, event_id, ts, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def _(spark, d):
    root = work_dir(spark)
    handle = state.upsert_state(f"{root}/out", ["user_id"], ["ts", "event_id"])
    events = ride_events(spark, d)
    punctual, tardy = events.filter(f"NOT ({_TARDY})"), events.filter(_TARDY)
    handle(punctual, 0)
    # what a failed attempt leaves: rows and a manifest that is not complete
    tardy.limit(1).write.parquet(f"{root}/out/data/failed/rows/_part=0")
    tardy.limit(1).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{root}/out/manifest/generation=1")
    handle(tardy, 1)
    handle(punctual, 0)
    return state.read_state(spark, f"{root}/out", schemas.EVENTS).select("user_id", "event_id", "ts", "event_type")


@query("st_07_enrichment", with_tables("customers", """
SELECT e.event_id, e.user_id, c.city, c.first_name AS segment FROM events e LEFT JOIN (
  SELECT substr(customer_id, 2)::BIGINT AS user_id, city, first_name FROM customers) c ON e.user_id = c.user_id"""))
def _(spark, d):
    from rideflow.sources.testdata import customers

    root = work_dir(spark)
    dim = customers(spark, d).select(F.substring("customer_id", 2, 20).cast("bigint").alias("user_id"), "city",
                                     F.col("first_name").alias("segment"))
    rows = jobs.enrich(_event_stream(spark, d), dim, "user_id").select("event_id", "user_id", "city", "segment")
    jobs.run_available_now(rows, f"{root}/out", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/out")


# Two versions of a customer: a second city holds from a day that depends on the customer.
@query("st_07_as_of", with_tables("customers", """
SELECT e.event_id, e.user_id, v.city FROM events e ASOF LEFT JOIN (
  SELECT substr(customer_id, 2)::BIGINT AS user_id, DATE '2024-01-05' AS valid_from, city FROM customers
  UNION ALL SELECT substr(customer_id, 2)::BIGINT, DATE '2024-01-10' + (substr(customer_id, 2)::BIGINT % 10)::INT, 'Pune' FROM customers) v
ON e.user_id = v.user_id AND e.ts >= v.valid_from"""))
def _(spark, d):
    from rideflow.sources.testdata import customers

    root = work_dir(spark)
    user = F.substring("customer_id", 2, 20).cast("bigint")
    known = customers(spark, d).select(user.alias("user_id"), F.lit("2024-01-05").cast("date").alias("valid_from"), "city")
    later = known.select("user_id", F.date_add(F.lit("2024-01-10").cast("date"), (F.col("user_id") % 10).cast("int")).alias("valid_from"), F.lit("Pune").alias("city"))
    _arrivals(spark, d, jobs.enrich_as_of(f"{root}/out", lambda: known.unionByName(later), "user_id", "ts", "valid_from", ["city"]), root)
    return spark.read.parquet(f"{root}/out/batch_id=*").select("event_id", "user_id", "city")
