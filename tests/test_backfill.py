"""A late date brings later dates up to date through the keys it changes, in one job whatever their number."""

import pytest
from pyspark.sql import functions as F

from rideflow import schemas
from rideflow.plans import lake
from rideflow.sources import sinks
from rideflow.sources.testdata import as_text, tables
from rideflow.sources.sinks import bronze_path
from rideflow.sources.workdir import work_dir

AT, SALT = "2026-10-08 12:00:00", "s"
DAYS = ["2026-10-05", "2026-10-06", "2026-10-07", "2026-10-08"]
LINEAGE = ("_source_file_uri", "_pipeline_run_id", "_processed_timestamp")


@pytest.fixture(scope="module")
def landings(spark, sf_dir):
    """Rides and payments come in overlapping parts; the customers of the second day come late and let rides of later days through."""
    raw = {n: as_text(df) for n, df in tables(spark, sf_dir).items()}
    share = lambda name, n, *parts: raw[name].filter(F.pmod(F.hash(F.lit(7), schemas.PRIMARY_KEYS[name]), F.lit(n)).isin(*parts))
    odd = raw["rides"].limit(3).withColumn("ride_id", F.lit(None).cast("string"))
    return {
        DAYS[0]: {"customers": share("customers", 3, 0), "drivers": share("drivers", 2, 0), "rides": share("rides", 12, 0)},
        DAYS[1]: {"customers": share("customers", 3, 1), "drivers": share("drivers", 2, 1), "rides": share("rides", 12, 1, 2), "payments": share("payments", 6, 0)},
        DAYS[2]: {"customers": share("customers", 3, 2), "rides": share("rides", 12, 1, 3).unionByName(odd), "payments": share("payments", 6, 0, 1)},
        DAYS[3]: {"customers": raw["customers"], "rides": share("rides", 12, 2, 3, 4), "payments": share("payments", 6, 1, 2)}}


def _state(spark, root):
    found = {}
    for name in lake.INCREMENTS:
        found[name] = sorted(map(str, lake.read_silver(spark, root, name).drop(*LINEAGE).collect()))
        bad = spark.read.option("basePath", f"{root}/quarantine/{name}").parquet(f"{root}/quarantine/{name}")
        found[f"bad {name}"] = sorted(map(str, bad.select("raw_record", "error_code", "error_message", F.col("dt").cast("string")).collect()))
        fact = lake.read_gold(spark, root, f"fact_{name}")
        found[f"fact {name}"] = sorted(map(str, fact.drop(*LINEAGE).collect()))
    return found


def test_late_date_equals_processing_in_order(spark, landings):
    ordered, late = work_dir(spark), work_dir(spark)
    for day in DAYS:
        lake.land_all(landings[day], ordered, day)
    assert lake.run(spark, ordered, "r", AT, SALT) == DAYS
    for day in (DAYS[0], DAYS[2], DAYS[3]):
        lake.land_all(landings[day], late, day)
    lake.run(spark, late, "r", AT, SALT)
    before = _state(spark, late)
    lake.land_all(landings[DAYS[1]], late, DAYS[1])
    assert lake.run(spark, late, "r2", AT, SALT) == DAYS[1:]
    want, got = _state(spark, ordered), _state(spark, late)
    assert before != want
    for name in want:
        assert got[name] == want[name], name
    assert lake.pending_dates(spark, late) == []
    # landed again without its customers and rides: what they let through is taken back, what they kept out comes in
    empty = {n: df.limit(0) for n, df in landings[DAYS[1]].items()}
    lake.land_all(empty, late, DAYS[1])
    lake.run(spark, late, "r3", AT, SALT)
    got = _state(spark, late)
    for name in before:
        assert got[name] == before[name], name


def test_unrelated_dates_are_not_written(spark, landings):
    root = work_dir(spark)
    for day in (DAYS[0], DAYS[3]):
        lake.land_all(landings[DAYS[3]] | {"drivers": landings[DAYS[0]]["drivers"]}, root, day)
    lake.run(spark, root, "r", AT, SALT)
    lake.land_all({"customers": landings[DAYS[3]]["customers"]}, root, DAYS[1])  # all of them are known from the first day
    assert lake.run(spark, root, "r2", AT, SALT) == [DAYS[1]]


def test_write_dates_replaces_whole_dates(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "v int, ingest_date string, year int"
    sinks.write_dates(spark.createDataFrame([(1, "a", 1), (2, "a", 2), (3, "b", 1), (4, "c", 1)], schema), path, ["a", "b", "c"], ("year",))
    sinks.write_dates(spark.createDataFrame([(9, "a", 1)], schema), path, ["a", "b"], ("year",))
    assert sorted((r.v, r.ingest_date, r.year) for r in spark.read.parquet(path).collect()) == [(4, "c", 1), (9, "a", 1)]
    flat = str(tmp_path / "f")
    sinks.write_dates(spark.createDataFrame([(1, "a"), (2, "b")], "v int, ingest_date string"), flat, ["a", "b"])
    sinks.write_dates(spark.createDataFrame([], "v int, ingest_date string"), flat, ["a"])
    assert [r.v for r in spark.read.parquet(flat).collect()] == [2] and (tmp_path / "f" / "ingest_date=a").exists()


def test_a_second_file_in_a_done_date_is_pending_and_erasure_leaves_nothing_pending(spark, landings):
    root = work_dir(spark)
    lake.land_all(landings[DAYS[0]], root, DAYS[0])
    assert lake.run(spark, root, "r1", AT, SALT) == [DAYS[0]]
    more = landings[DAYS[3]]["customers"].select([F.col(c).cast("string").alias(c) for c in landings[DAYS[3]]["customers"].columns])
    more.write.mode("append").option("header", True).csv(bronze_path(root, "customers", DAYS[0]))
    assert lake.pending_dates(spark, root) == [DAYS[0]]
    assert lake.run(spark, root, "r2", AT, SALT) == [DAYS[0]]
    assert lake.pending_dates(spark, root) == []
    subject = lake.read_silver(spark, root, "customers").select("customer_id").limit(1)
    assert lake.erase_subjects(spark, root, subject)["customers"] == [DAYS[0]]
    assert lake.pending_dates(spark, root) == []
