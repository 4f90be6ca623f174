import datetime as dt

from pyspark.sql import functions as F

from rideflow import schemas
from rideflow.operators.quality import Rule
from rideflow.sources.workdir import work_dir
from rideflow.streaming import jobs
from tests.conftest import rows


def event(i, hour, minute, user=1, kind="view"):
    return (i, dt.datetime(2024, 1, 1, hour, minute), user, kind, 1.0, "{}")


def arrive(spark, path, *events):
    spark.createDataFrame(list(events), schemas.EVENTS).coalesce(1).write.mode("append").parquet(path)


def test_late_events_are_routed_not_lost(spark):
    root = work_dir(spark)
    handle = jobs.route_late(f"{root}/out")
    arrive(spark, f"{root}/in", event(1, 9, 0), event(2, 10, 0))
    jobs.run_batches(jobs.file_stream(spark, f"{root}/in", schemas.EVENTS), handle, f"{root}/cp")
    arrive(spark, f"{root}/in", event(3, 9, 49), event(4, 9, 50), event(5, 11, 0))
    jobs.run_batches(jobs.file_stream(spark, f"{root}/in", schemas.EVENTS), handle, f"{root}/cp")
    got = spark.read.option("basePath", f"{root}/out/events").parquet(f"{root}/out/events/batch_id=*")
    assert {r.event_id: r.late for r in got.select("event_id", F.col("late").cast("boolean").alias("late")).collect()} == {
        1: False, 2: False, 3: True, 4: False, 5: False}


def test_replayed_batch_replaces_its_output(spark):
    root = work_dir(spark)
    handle = jobs.route_late(f"{root}/out")
    batch = spark.createDataFrame([event(1, 9, 0)], schemas.EVENTS)
    handle(batch, 0)
    handle(batch, 0)
    assert spark.read.parquet(f"{root}/out/events/batch_id=0").count() == 1


def test_dedupe_within_watermark_across_runs(spark):
    root = work_dir(spark)
    for batch in ([event(1, 9, 0), event(1, 9, 0)], [event(1, 9, 0), event(2, 9, 1)]):
        arrive(spark, f"{root}/in", *batch)
        once = jobs.dedupe_events(jobs.file_stream(spark, f"{root}/in", schemas.EVENTS)).select("event_id")
        jobs.run_available_now(once, f"{root}/out", f"{root}/cp")
    assert sorted(r.event_id for r in spark.read.parquet(f"{root}/out").collect()) == [1, 2]


def test_hourly_windows_close_with_the_watermark(spark):
    root = work_dir(spark)
    arrive(spark, f"{root}/in", event(1, 9, 59), event(2, 9, 0), event(3, 10, 5), event(4, 11, 30))
    jobs.run_available_now(jobs.hourly_demand(jobs.file_stream(spark, f"{root}/in", schemas.EVENTS)), f"{root}/out", f"{root}/cp")
    got = rows(spark.read.parquet(f"{root}/out").select("window_start", "events"), "window_start")
    assert [(g["window_start"].hour, g["events"]) for g in got] == [(9, 2), (10, 1)]


def test_split_batches(spark):
    root = work_dir(spark)
    arrive(spark, f"{root}/in", event(1, 9, 0), event(2, 9, 0, kind="odd"))
    handle = jobs.split_batches(f"{root}/out", lambda b: b, (Rule("KIND", "event_type = 'view'", "kind"),))
    jobs.run_batches(jobs.file_stream(spark, f"{root}/in", schemas.EVENTS), handle, f"{root}/cp")
    got = spark.read.option("basePath", f"{root}/out").parquet(f"{root}/out/batch_id=*")
    assert {r.event_id: str(r.ok).lower() for r in got.select("event_id", "ok").collect()} == {1: "true", 2: "false"}


def test_upsert_state_and_compaction(spark):
    root = work_dir(spark)
    handle = jobs.upsert_log(f"{root}/out", "user_id", "ts")
    for batch in ([event(1, 9, 0), event(2, 9, 5), event(3, 9, 0, user=2)], [event(4, 9, 1), event(5, 9, 9, user=2)]):
        arrive(spark, f"{root}/in", *batch)
        jobs.run_batches(jobs.file_stream(spark, f"{root}/in", schemas.EVENTS), handle, f"{root}/cp")
    state = jobs.current_state(spark, f"{root}/out", schemas.EVENTS, "user_id", "ts")
    assert {r.user_id: r.event_id for r in state.collect()} == {1: 2, 2: 5}
    jobs.compact_state(spark, f"{root}/out", schemas.EVENTS, "user_id", "ts", f"{root}/compact")
    again = jobs.current_state(spark, f"{root}/compact", schemas.EVENTS, "user_id", "ts")
    assert {r.user_id: r.event_id for r in again.collect()} == {1: 2, 2: 5}
    # a new stream continues the compacted log without replacing its base
    arrive(spark, f"{root}/in2", event(6, 9, 30, user=3))
    jobs.run_batches(jobs.file_stream(spark, f"{root}/in2", schemas.EVENTS), jobs.upsert_log(f"{root}/compact", "user_id", "ts"), f"{root}/cp2")
    grown = jobs.current_state(spark, f"{root}/compact", schemas.EVENTS, "user_id", "ts")
    assert {r.user_id: r.event_id for r in grown.collect()} == {1: 2, 2: 5, 3: 6}
