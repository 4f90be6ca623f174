"""Stream state by generations, windows as upserts, the ledger of files."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rideflow import schemas
from rideflow.operators import privacy
from rideflow.sources import ledger
from rideflow.sources.workdir import work_dir
from rideflow.streaming import jobs, state
from tests.conftest import rows
from tests.test_streaming import arrive, event

SCHEMA = "k string, n long, v string"


def batch(spark, *some):
    return spark.createDataFrame(list(some), SCHEMA)


def values(spark, root, generation=None):
    return {r.k: (r.n, r.v) for r in state.read_state(spark, root, batch(spark).schema, generation).collect()}


def test_state_keeps_the_newest_row_and_old_generations(spark):
    root = work_dir(spark)
    handle = state.upsert_state(root, ["k"], ["n"], 8)
    assert values(spark, root) == {}
    handle(batch(spark, ("a", 1, "x"), ("b", 5, "x"), (None, 1, "x"), ("a", 2, "y")), 0)
    handle(batch(spark, ("a", 2, "b"), ("b", 4, "late"), ("c", 1, "z")), 1)
    assert values(spark, root) == {"a": (2, "b"), "b": (5, "x"), "c": (1, "z"), None: (1, "x")}
    assert values(spark, root, 0) == {"a": (2, "y"), "b": (5, "x"), None: (1, "x")}
    with pytest.raises(ValueError):
        values(spark, root, 7)


def test_only_touched_parts_are_written(spark):
    root = work_dir(spark)
    handle = state.upsert_state(root, ["k"], ["n"], 16)
    handle(spark.range(1000).select(F.col("id").cast("string").alias("k"), F.lit(0).cast("long").alias("n"), F.lit("x").alias("v")), 0)
    before = state._folders(spark, root, 0)
    handle(batch(spark, ("7", 1, "y")), 1)
    after = state._folders(spark, root, 1)
    assert len(before) == 16 and sum(before[p] != after[p] for p in before) == 1
    handle(batch(spark), 2)
    assert state._folders(spark, root, 2) == after and len(values(spark, root)) == 1000


def test_a_batch_that_fails_or_comes_again_counts_once(spark, monkeypatch):
    root = work_dir(spark)
    handle = state.upsert_state(root, ["k"], [], 4)
    handle(batch(spark, ("a", 1, "x"), ("b", 1, "x")), 0)
    publish = state._publish

    def fails(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(state, "_publish", fails)
    with pytest.raises(RuntimeError):
        handle(batch(spark, ("a", 2, "half")), 1)
    monkeypatch.setattr(state, "_publish", publish)
    assert values(spark, root) == {"a": (1, "x"), "b": (1, "x")}
    handle(batch(spark, ("a", 3, "whole")), 1)
    handle(batch(spark, ("b", 9, "again")), 1)
    handle(batch(spark, ("b", 9, "again")), 0)
    assert values(spark, root) == {"a": (3, "whole"), "b": (1, "x")}
    assert state.generations(spark, root) == [0, 1]
    gone = state.forget(spark, root, 1)
    assert gone and state.generations(spark, root) == [1]
    assert values(spark, root) == {"a": (3, "whole"), "b": (1, "x")}


def test_rehash_and_go_on(spark):
    root, target = work_dir(spark), work_dir(spark)
    state.upsert_state(root, ["k"], ["n"], 2)(batch(spark, *[(str(i), i, "x") for i in range(40)]), 3)
    state.rehash(spark, root, batch(spark).schema, ["k"], target, 8)
    assert len(state._folders(spark, target, 3)) > 2
    handle = state.upsert_state(target, ["k"], ["n"], 2)
    handle(batch(spark, ("1", 0, "replayed")), 3)
    handle(batch(spark, ("1", 100, "new")), 4)
    got = values(spark, target)
    assert len(got) == 40 and got["1"] == (100, "new") and got["2"] == (2, "x")


def test_open_windows_are_reported_and_replaced(spark):
    root = work_dir(spark)
    schema = "window_start timestamp_ntz, window_end timestamp_ntz, event_type string, events long, value decimal(18,2)"
    seen = []
    for some in ([event(1, 9, 59), event(2, 9, 0)], [event(3, 9, 58), event(4, 10, 5)], [event(5, 8, 0), event(6, 10, 6)]):
        arrive(spark, f"{root}/in", *some)
        jobs.demand_upserts(jobs.file_stream(spark, f"{root}/in", schemas.EVENTS), f"{root}/out", f"{root}/cp", parts=4)
        got = rows(state.read_state(spark, f"{root}/out", schema).select("window_start", "events"), "window_start")
        seen.append([(g["window_start"].hour, g["events"]) for g in got])
    # the event of 8:00 is older than the newest before it by more than the delay
    assert seen == [[(9, 2)], [(9, 3), (10, 1)], [(9, 3), (10, 2)]]


def test_progress_reads_one_row(spark):
    root = work_dir(spark)
    handle = jobs.route_late(f"{root}/out")
    for number, at in enumerate(((10, 0), (9, 0), (9, 30))):
        handle(spark.createDataFrame([event(number, *at)], schemas.EVENTS), number)
    handle(spark.createDataFrame([], schemas.EVENTS), 3)
    assert [spark.read.parquet(f"{root}/out/progress/batch_id={i}").first()[0] for i in range(4)] == [dt.datetime(2024, 1, 1, 10)] * 4


def write(spark, path, name, text):
    spark.createDataFrame([(text,)], "v string").coalesce(1).write.mode("append").text(f"{path}/{name}")


def test_ledger_tells_files_by_path_size_and_time(spark):
    root = work_dir(spark)
    for name in ("a", "b"):
        write(spark, f"{root}/in", name, name)
    files = ledger.list_files(spark, f"{root}/in").withColumn("entry", F.regexp_extract("file", "/in/([^/]+)/", 1))
    assert ledger.pending_files(files, ledger.read_ledger(spark, f"{root}/ledger")).count() == 2
    ledger.record(files, f"{root}/ledger")
    ledger.record(files.filter("entry = 'a'"), f"{root}/ledger")
    done = ledger.read_ledger(spark, f"{root}/ledger")
    assert done.count() == 2 and {(r.entry, r.files) for r in done.collect()} == {("a", 1), ("b", 1)}
    assert ledger.pending_files(files, done).count() == 0 and ledger.changed_groups(files, done, "entry").count() == 0
    # another time with the same path and size, and a file that is gone while others remain
    later = files.withColumn("modified", F.col("modified") + F.when(F.col("entry") == "a", -1).otherwise(0))
    assert [r.entry for r in ledger.changed_groups(later, done, "entry").collect()] == ["a"]
    more = done.unionByName(done.filter("entry = 'b'").withColumn("file", F.lit("file:/gone")))
    assert [r.entry for r in ledger.changed_groups(files, more, "entry").collect()] == ["b"]
    # all files of an entry archived: nothing to do
    assert ledger.changed_groups(files.filter("entry = 'a'"), done, "entry").count() == 0
    write(spark, f"{root}/in", "b", "second")
    now = ledger.list_files(spark, f"{root}/in").withColumn("entry", F.regexp_extract("file", "/in/([^/]+)/", 1))
    assert ledger.pending_files(now, done).count() == 1
    assert [r.entry for r in ledger.changed_groups(now, done, "entry").collect()] == ["b"]


def test_scan_of_tables_checks_the_digit(spark):
    t = spark.createDataFrame([("4111111111111111 4111111111111112", 1), ("4111 1111 1111 1112", 1), ("x 4111-1111-1111-1111", 2), ("94111111111111111", 2),
                               (None, 3), ("", 3)], "c string, n int")
    got = privacy.pii_scan_tables({"t": t, "numbers": t.select("n")})
    assert {(r.table_name, r.column_name, r.pattern): r.hits for r in got.collect()} == {("t", "c", "card"): 2, ("t", "c", "email"): 0, ("t", "c", "phone"): 0}
