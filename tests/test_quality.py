import datetime as dt
import json
from collections import Counter
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from rideflow import schemas
from rideflow.operators import quality
from rideflow.operators import silver as steps
from rideflow.operators.quality import ForeignKey, Rule, Unique
from rideflow.plans import load
from rideflow.sources.testdata import as_text, tables
from rideflow.sources.workdir import work_dir
from tests.conftest import rows


def codes(df, key):
    return {r[key]: sorted(f.code for f in r.failures) for r in df.collect()}


def test_every_row_lands_on_exactly_one_side_and_null_fails(spark):
    df = spark.createDataFrame([(1, 5), (2, -5), (3, None), (None, 1)], "id int, fare int")
    rules = (Rule("NULL_PK", "id IS NOT NULL", "id"), Rule("NEGATIVE_FARE", "fare >= 0", "fare"))
    valid, bad = quality.split(df, rules)
    assert [r.id for r in valid.collect()] == [1]
    assert codes(bad, "id") == {2: ["NEGATIVE_FARE"], 3: ["NEGATIVE_FARE"], None: ["NULL_PK"]}


def test_all_reasons_are_kept(spark):
    df = spark.createDataFrame([(1, -5, "x")], "id int, fare int, s string")
    rules = (Rule("A", "fare >= 0", "a"), Rule("B", "s = 'ok'", "b"), Rule("W", "fare > 100", "w", quality.WARNING))
    row = quality.evaluate(df, rules).first()
    assert [f.code for f in row.failures] == ["A", "B"] and row.warnings == ["W"]


def test_no_rules_means_valid(spark):
    assert quality.evaluate(spark.range(2)).filter("size(failures) = 0 AND size(warnings) = 0").count() == 2


def test_foreign_key_null_and_orphan(spark):
    parents = spark.createDataFrame([("a",), ("a",), (None,)], "id string")
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, k string")
    judged = quality.evaluate(df, (), (ForeignKey("ORPHAN", "k", parents, "id"),))
    assert codes(judged, "id") == {1: [], 2: ["ORPHAN"], 3: ["NULL_REQUIRED"]}


@pytest.mark.parametrize("staged", [False, True])
def test_unique_counts_valid_rows_only(spark, staged):
    df = spark.createDataFrame([(1, "e", -1), (2, "e", 1), (3, "e", 1), (4, None, 1), (5, "f", 1), (5, "f", 1)], "id int, email string, v int")
    args = (df, (Rule("NEG", "v >= 0", "v"),), (), (Unique("DUP_EMAIL", ("email",), ("email", "id"), "d"), Unique("DUP_PK", ("id",), ("id",), "p")))
    judged = quality.judge(*args, stage_in=work_dir(spark)) if staged else quality.evaluate(*args)
    got = Counter((r.id, tuple(sorted(f.code for f in r.failures))) for r in judged.collect())
    assert got == Counter({(1, ("NEG",)): 1, (2, ()): 1, (3, ("DUP_EMAIL",)): 1, (4, ("NULL_REQUIRED",)): 1,
                           (5, ()): 1, (5, ("DUP_EMAIL",)): 1})


def test_judge_equals_evaluate_on_all_datasets(spark, sf_dir):
    frames = tables(spark, sf_dir)
    plain = load.evaluate_all(frames)
    stored = load.evaluate_all(frames, stage_in=work_dir(spark))
    for name in schemas.DATASETS:
        def verdicts(df):
            return Counter((r[0], tuple(sorted(f.code for f in r.failures))) for r in df.collect())
        assert verdicts(plain[name]) == verdicts(stored[name]), name


def test_cascade_rejects_children_of_rejected_parents(spark):
    ts = dt.datetime(2024, 1, 1)
    def text(schema, *records):
        return spark.createDataFrame([tuple(r.get(c) for c in schema.names) for r in records], schemas.as_text(schema))
    customer = dict(customer_id="c1", first_name="A", last_name="B", email="e", phone="1", city="Pune", signup_date="2024-01-01", is_active="True")
    driver = dict(driver_id="d1", first_name="A", last_name="B", phone="1", city="Pune", vehicle_type="SUV", license_number="L",
                  rating="4.5", join_date="2024-01-01", is_active="true")
    ride = dict(ride_id="r1", customer_id="c1", driver_id="d1", pickup_city="Pune", pickup_area="A", dropoff_city="Pune", dropoff_area="B",
                pickup_lat="18.9", pickup_lon="72.8", dropoff_lat="18.9", dropoff_lon="72.8", request_time=str(ts), pickup_time=str(ts),
                dropoff_time=str(ts), distance_km="1.5", fare="10", surge_multiplier="1.0", ride_status="completed")
    payment = dict(payment_id="p1", ride_id="r1", customer_id="c1", amount="10", payment_method="UPI", payment_status="completed",
                   payment_time=str(ts), tip_amount="0")
    frames = {
        "customers": text(schemas.CUSTOMERS, customer, {**customer, "customer_id": "c2", "email": None}),
        "drivers": text(schemas.DRIVERS, driver),
        "rides": text(schemas.RIDES, ride, {**ride, "ride_id": "r2", "customer_id": "c2"}),
        "payments": text(schemas.PAYMENTS, payment, {**payment, "payment_id": "p2", "ride_id": "r2"}),
    }
    typed = {n: steps.clean(df, n) for n, df in frames.items()}
    judged = load.evaluate_all(typed)
    assert codes(judged["customers"], "customer_id") == {"c1": [], "c2": ["NULL_EMAIL"]}
    assert codes(judged["rides"], "ride_id") == {"r1": [], "r2": ["ORPHAN_CUSTOMER"]}
    assert codes(judged["payments"], "payment_id") == {"p1": [], "p2": ["ORPHAN_RIDE"]}
    assert judged["drivers"].first().is_active is False  # only exactly 'True' is true


def test_documented_counts(spark):
    """The counts fixed for scale factor 0.01."""
    frames = tables(spark, "/root/testdata/sf0.01")
    before = load.evaluate_all(frames, primary_keys=False, stage_in=work_dir(spark))
    accepted = {n: quality.accepted(df) for n, df in before.items()}
    assert [accepted[n].count() for n in schemas.DATASETS] == [1485, 98, 57008, 6258]
    assert accepted["rides"].select("ride_id").distinct().count() == 44017
    rides = frames["rides"].agg(
        F.count("*"), F.countDistinct("ride_id"), F.count_if(F.col("distance_km") < 0), F.count_if(F.col("fare") == 0),
        F.count_if(F.col("pickup_lat") > 90), F.count_if(F.col("dropoff_time") < F.col("pickup_time"))).first()
    assert tuple(rides) == (60000, 45832, 1217, 587, 314, 304)


def test_silver_rules_on_bad_rides(spark, sf_dir):
    base = tables(spark, sf_dir)["rides"].filter("ride_status = 'completed' AND fare > 0 AND distance_km > 0 AND pickup_lat < 90 "
                                                 "AND dropoff_time > pickup_time AND length(ride_id) <= 10").limit(1)
    cases = {"ZERO_FARE": {"fare": "0"}, "NEGATIVE_FARE": {"fare": "-1"}, "INVALID_TIMESTAMPS": {"dropoff_time": None},
             "INVALID_COORDINATES": {"dropoff_lon": "181"}, "STRING_TOO_LONG": {"pickup_city": "x" * 51},
             "NULL_REQUIRED": {"pickup_area": None}, "MALFORMED_VALUE": {"fare": "banana"}, "INVALID_SURGE": {"surge_multiplier": "0.9"},
             "INVALID_RIDE_STATUS": {"ride_status": "lost"}, "NULL_PK": {"ride_id": None}}
    for code, change in cases.items():
        raw = as_text(base).withColumns({k: F.lit(v).cast("string") for k, v in change.items()})
        failures = quality.evaluate(steps.clean(raw, "rides"), quality.silver_rules("rides")).first().failures
        assert code in {f.code for f in failures}, code
    clean_row = quality.evaluate(steps.clean(as_text(base), "rides"), quality.silver_rules("rides")).first()
    assert clean_row.failures == []


def test_quarantine_record(spark):
    df = spark.createDataFrame([(1, -5, None)], "id int, fare int, note string")
    judged = quality.evaluate(df, (Rule("NEGATIVE_FARE", "fare >= 0", "fare must be >= 0"), Rule("NULL_NOTE", "note IS NOT NULL", "n")))
    got = rows(quality.quarantine(judged, "s.csv", "run-1", "2026-09-01 08:15:00"), "error_code")
    assert [g["error_code"] for g in got] == ["NEGATIVE_FARE", "NULL_NOTE"]
    assert json.loads(got[0]["raw_record"]) == {"id": 1, "fare": -5, "note": None}
    assert got[0]["dt"] == "2026-09-01" and got[0]["source_file"] == "s.csv" and got[0]["pipeline_run_id"] == "run-1"


def test_assertions(spark):
    df = spark.createDataFrame([(1, 1), (1, 2)], "id int, fare int")
    assert quality.assert_all(df, {"fare": "fare > 0"})["row_count"] == 2
    for args in (({"fare": "fare > 1"}, None), ({}, ["id"])):
        with pytest.raises(quality.AssertionsFailed):
            quality.assert_all(df, *args)
    with pytest.raises(quality.AssertionsFailed):
        quality.assert_all(df.filter("id > 1"), {})


def test_alert_levels(spark):
    values = [("rejection_rate_pct", "5.00", "ok"), ("rejection_rate_pct", "5.01", "warning"), ("rejection_rate_pct", "15.01", "critical"),
              ("duplicate_rate_pct", "2.01", "critical"), ("null_pk_rate_pct", "0.01", "warning"), ("null_pk_rate_pct", "99.00", "warning"),
              ("volume_drop_pct", "30.00", "ok"), ("volume_drop_pct", "61.00", "critical")]
    df = spark.createDataFrame([(m, D(v), w) for m, v, w in values], "metric string, value decimal(18,2), want string")
    assert all(r.level == r.want for r in quality.alerts(df).collect())


def test_contract(spark):
    good = spark.createDataFrame([], schemas.PAYMENTS)
    assert quality.check_contract(good, schemas.PAYMENTS) == []
    bad = good.drop("ride_id").withColumn("amount", F.col("amount").cast("double")).withColumn("extra", F.lit(1))
    assert len(quality.check_contract(bad, schemas.PAYMENTS)) == 3


def test_align_schema(spark):
    old = spark.createDataFrame([("p1", "Cash", 1)], "payment_id string, method string, terminal int")
    got = steps.align_schema(old, schemas.PAYMENTS, {"method": "payment_method"})
    assert got.columns == schemas.PAYMENTS.names
    assert got.first().payment_method == "Cash" and got.first().amount is None
    assert steps.extra_columns(old, schemas.PAYMENTS) == ["method", "terminal"]
