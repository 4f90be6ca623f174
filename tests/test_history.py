"""Versions by time: the point-in-time join, and histories that grow with the lake."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from rideflow import schemas
from rideflow.operators import gold
from rideflow.operators.history import as_of
from rideflow.plans import lake
from rideflow.sources.testdata import as_text, tables
from rideflow.sources.workdir import work_dir
from tests.conftest import plan

START = dt.datetime(2024, 1, 1)
VERSIONS = [(k, dt.date(2024, 1, d), f"{k}{d}") for k, days in (("a", (3, 9)), ("hot", (2, 5, 6, 19)), ("none", (1,))) for d in days]


def _events(n=2000, seed=1):
    rng = random.Random(seed)
    found = [(i, rng.choice(["a", "b", None, "hot", "hot", "hot"]), START + dt.timedelta(minutes=rng.randrange(60 * 24 * 20))) for i in range(n)]
    exact = [(n + i, k, dt.datetime.combine(d, dt.time())) for i, (k, d, _) in enumerate(VERSIONS)]
    return found + exact + [(n + 100, "hot", None), (5, "hot", START), (5, "hot", START)]


def _valid(k, t, open_start):
    own = [(d, v) for key, d, v in VERSIONS if key == k] if t else []
    past = [v for d, v in own if dt.datetime.combine(d, dt.time()) <= t]
    return past[-1] if past else own[0][1] if own and open_start else None


@pytest.mark.parametrize("open_start", [False, True])
@pytest.mark.parametrize(("hours", "compared"), [(1, 0), (7, 0), (1000, 0), (24, 3), (24, 4)])
def test_as_of_is_the_newest_version_before(spark, open_start, hours, compared):
    events = _events()
    got = as_of(spark.createDataFrame(events, "id int, k string, t timestamp_ntz"), spark.createDataFrame(VERSIONS, "k string, since date, v string"),
                "k", "t", "since", ["v"], open_start, hours, compared)
    assert got.columns == ["id", "k", "t", "v"]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(str((i, k, t, _valid(k, t, open_start))) for i, k, t in events)


def test_as_of_small_cases(spark):
    events = spark.createDataFrame([(1, "a", START)], "id int, k string, t timestamp_ntz")
    versions = spark.createDataFrame(VERSIONS, "k string, since date, v string")
    assert as_of(events, versions.limit(0), "k", "t", "since", ["v"]).first().v is None
    assert as_of(events.limit(0), versions, "k", "t", "since", ["v"]).collect() == []
    many = spark.range(100).selectExpr("'a' AS k", "date_add(DATE'2023-12-20', cast(id AS int)) AS since", "cast(id AS string) AS v")
    assert as_of(events, many, "k", "t", "since", ["v"]).first().v == "12"
    assert "Window" not in plan(as_of(events, versions, "k", "t", "since", ["v"]))
    with pytest.raises(ValueError):
        as_of(events.withColumn("v", F.lit(1)), versions, "k", "t", "since", ["v"])


def test_a_hot_key_is_cut_by_time(spark):
    """No window of the merge holds all events of a key."""
    events = spark.createDataFrame(_events(), "id int, k string, t timestamp_ntz")
    text = plan(as_of(events, spark.createDataFrame(VERSIONS, "k string, since date, v string"), "k", "t", "since", ["v"], compared=0))
    dealt = [line for line in text.splitlines() if "hashpartitioning(_key" in line]
    assert sum("_slice" in line for line in dealt) >= 1 and all("_event" not in line for line in dealt if "_slice" not in line)


@pytest.fixture(scope="module")
def deliveries(spark, sf_dir):
    frames = {n: as_text(df) for n, df in tables(spark, sf_dir).items()}
    moved = frames["customers"].withColumn("city", F.when(F.col("customer_id").endswith("1"), "Pune").otherwise(F.col("city")))
    some = frames["rides"].filter("pmod(hash(ride_id), 20) = 0")
    return {"1996-01-01": {"customers": moved, "drivers": frames["drivers"]}, "1997-01-01": {"customers": frames["customers"], "drivers": frames["drivers"]},
            "2026-10-08": {"customers": moved, "drivers": frames["drivers"], "rides": some, "payments": frames["payments"]}}


def _history(spark, path, entity="customer"):
    return sorted(map(str, lake.read_gold(spark, path, f"dim_{entity}_history").collect()))


def test_histories_grow_as_if_built_at_once(spark, deliveries):
    days = list(deliveries)
    together, stepwise = work_dir(spark), work_dir(spark)
    for day in days:
        lake.land_all(deliveries[day], together, day)
    assert lake.run(spark, together, "r", "2026-10-08 12:00:00", "s") == days
    for day in (days[0], days[2], days[1]):  # the day in the middle comes late
        lake.land_all(deliveries[day], stepwise, day)
        lake.run(spark, stepwise, "r", "2026-10-08 12:00:00", "s")
    for entity in ("customer", "driver"):
        assert _history(spark, together, entity) == _history(spark, stepwise, entity)
    lake.check_gold(spark, stepwise)
    versions = lake.read_gold(spark, together, "dim_customer_history")
    assert versions.groupBy("customer_key").count().agg(F.max("count")).first()[0] == 3
    assert versions.where("is_current").count() == lake.read_gold(spark, together, "dim_customer").count()
    fact = lake.read_gold(spark, together, "fact_rides").join(versions.drop("customer_key"), "customer_version")
    off = fact.where("request_time < valid_from AND valid_from > DATE'1996-01-01' OR request_time >= valid_to")
    assert fact.count() > 0 and off.count() == 0
    keys = {name: [f.name for f in df.schema] for name, df in lake.gold_tables(spark, together).items()}
    assert {"customer_version", "driver_version"} <= set(keys["fact_rides"]) and set(schemas.DATASETS) == set(lake.ENTITIES) | set(lake.INCREMENTS)


def test_version_keys_do_not_depend_on_later_versions(spark):
    rows = [(1, "x", "2024-01-01"), (1, "y", "2024-02-01"), (1, "x", "2024-03-01")]
    schema = "customer_key long, city string, day string"
    one = gold.dim_history(spark.createDataFrame(rows[:1], schema), "customer", "day").collect()
    all_ = gold.dim_history(spark.createDataFrame(rows, schema), "customer", "day").orderBy("valid_from").collect()
    assert one[0].customer_version == all_[0].customer_version and [r.city for r in all_] == ["x", "y", "x"]
    assert [str(r.valid_to) for r in all_] == ["2024-02-01", "2024-03-01", "None"] and [r.is_current for r in all_] == [False, False, True]
