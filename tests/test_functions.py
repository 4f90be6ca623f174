from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from rideflow.functions import geo, keys, numeric, text, times
from tests.conftest import rows


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return df.select(column.alias("x")).first()[0]


@pytest.mark.parametrize("lat, lon, precision, cell", [
    (57.64911, 10.40744, 6, "u4pruy"), (57.64911, 10.40744, 11, "u4pruydqqvj"), (90.0, 180.0, 3, "zzz"),
    (-90.0, -180.0, 4, "0000"), (91.0, 0.0, 6, None), (None, 0.0, 6, None)])
def test_geo_cell(spark, lat, lon, precision, cell):
    df = spark.createDataFrame([(lat, lon)], "lat double, lon double")
    assert df.select(geo.geo_cell("lat", "lon", precision)).first()[0] == cell


def test_geo_cell_rejects_precision():
    with pytest.raises(ValueError):
        geo.geo_cell("a", "b", 13)


@pytest.mark.parametrize("values, mean", [
    (["1.00", "1.01"], "1.01"), (["-1.00", "-1.01"], "-1.01"), (["0.01", "0.02", "0.02"], "0.02"), ([None], None)])
def test_mean_rounds_half_away_from_zero(spark, values, mean):
    df = spark.createDataFrame([(D(v) if v else None,) for v in values], "x decimal(12,2)")
    got = df.agg(numeric.mean("x")).first()[0]
    assert got == (D(mean) if mean else None)


def test_mean_of_nothing_is_null(spark):
    assert spark.createDataFrame([], "x decimal(12,2)").agg(numeric.mean("x")).first()[0] is None


def test_percent(spark):
    df = spark.createDataFrame([(1, 3), (1, 16), (0, 0)], "a long, b long")
    assert [r[0] for r in df.select(numeric.percent(F.col("a"), F.col("b"))).collect()] == [D("33.3"), D("6.3"), None]


@pytest.mark.parametrize("raw, city", [
    ("pune", "Pune"), ("PUNE", "Pune"), ("pune ", "Pune"), ("Bengaluru", "Bangalore"), ("NEW DELHI", "Delhi"), (None, None)])
def test_clean_city(spark, raw, city):
    df = spark.createDataFrame([(raw,)], "c string")
    assert df.select(text.clean_city(F.col("c"))).first()[0] == city


@pytest.mark.parametrize("raw", ["2026-08-25 10:30:00", "2026-08-25T10:30:00", "2026-08-25T10:30:00Z", " 2026-08-25 10:30:00 "])
def test_parse_timestamp_accepts_all_forms(spark, raw):
    assert one(spark, times.parse_timestamp("t"), t=raw).isoformat() == "2026-08-25T10:30:00"


@pytest.mark.parametrize("raw", ["soon", "2026", "2026-08-25", "2026-08-25T10:30:00+05:30", "2026-13-01 10:30:00"])
def test_parse_timestamp_rejects(spark, raw):
    assert one(spark, times.parse_timestamp("t"), t=raw) is None


def test_masks(spark):
    df = spark.createDataFrame([("priya@gmail.com", "+91 98765 43210", "Priya")], "e string, p string, n string")
    got = df.select(text.email_partial("e"), text.phone_last4("p"), text.initial("n"), keys.salted_hash("e", "s")).first()
    assert got[:3] == ("p***@gmail.com", "***-***-3210", "P***")
    assert len(got[3]) == 64


def test_surrogate_key_is_null_with_a_null_part(spark):
    df = spark.createDataFrame([("a", None), ("a", "b")], "x string, y string")
    got = [r[0] for r in df.select(keys.surrogate_key("x", "y")).collect()]
    assert got[0] is None and got[1] > 0


def test_surrogate_key_tells_separators_from_parts(spark):
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), ("a\\", "|b"), ("a\\|", "b"), ("a", "b")], "x string, y string")
    assert df.select(keys.surrogate_key("x", "y")).distinct().count() == 5


def test_calendar_parts_sunday_is_one(spark):
    parts = times.calendar_parts("t")
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-07 23:59:59' AS t").select(*[c.alias(n) for n, c in parts.items()])
    got = rows(df)[0]
    assert (got["day_of_week"], got["ride_hour"], got["month"], got["year"]) == (1, 23, 1, 2024)


def test_minutes_between_null(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-07 10:00:00' AS a, CAST(NULL AS TIMESTAMP_NTZ) AS b, TIMESTAMP_NTZ'2024-01-07 10:05:59' AS c")
    assert df.select(times.minutes_between("a", "b"), times.minutes_between("a", "c")).first() == (None, 5)
