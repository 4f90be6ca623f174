"""The four ride-hailing datasets and the event stream, derived from the given order tables.

Dirty rows come from fixed arithmetic on the keys, so another engine can derive the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def load(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """Scan one Parquet table."""
    return spark.read.parquet(f"{directory}/{name}.parquet")


def _city(key: str) -> str:
    return (f"CASE {key} % 6 WHEN 0 THEN 'Mumbai' WHEN 1 THEN 'Pune' WHEN 2 THEN 'Bangalore' "
            f"WHEN 3 THEN 'Delhi' WHEN 4 THEN 'Hyderabad' ELSE 'Chennai' END")


def _padded(prefix: str, key: str, width: int) -> str:
    # lpad cuts longer keys, so the width grows with the key.
    return f"concat('{prefix}', lpad({key}, greatest({width}, length({key})), '0'))"


def customers(spark: SparkSession, directory: str) -> DataFrame:
    """is_active stays raw text, as in the source files."""
    return load(spark, directory, "customer").selectExpr(
        _padded("C", "c_custkey", 7) + " AS customer_id",
        "c_mktsegment AS first_name",
        "substr(c_name, 10) AS last_name",
        "concat('u', CASE WHEN c_custkey % 100 = 99 THEN c_custkey - 1 ELSE c_custkey END, '@example.com') AS email",
        "concat('+91 ', lpad(c_custkey * 7919 % 10000000000, 10, '0')) AS phone",
        _city("c_nationkey") + " AS city",
        "date_add(DATE'1994-01-01', CAST(c_custkey % 365 AS INT)) AS signup_date",
        "CASE WHEN c_acctbal < 0 THEN 'False' ELSE 'True' END AS is_active",
    )


def drivers(spark: SparkSession, directory: str) -> DataFrame:
    return load(spark, directory, "supplier").selectExpr(
        _padded("D", "s_suppkey", 5) + " AS driver_id",
        "substr(s_name, 1, 8) AS first_name",
        "substr(s_name, 10) AS last_name",
        "concat('+91 ', lpad(s_suppkey * 104729 % 10000000000, 10, '0')) AS phone",
        _city("s_nationkey") + " AS city",
        "CASE s_suppkey % 5 WHEN 0 THEN 'Sedan' WHEN 1 THEN 'Hatchback' WHEN 2 THEN 'SUV' "
        "WHEN 3 THEN 'Auto' ELSE 'Bike' END AS vehicle_type",
        "concat('MH-', lpad(CASE WHEN s_suppkey % 50 = 49 THEN s_suppkey - 1 ELSE s_suppkey END, 10, '0')) "
        "AS license_number",
        "CAST(1.0 + (s_suppkey % 41) * 0.1 AS DECIMAL(3,1)) AS rating",
        "date_add(DATE'1993-01-01', CAST(s_suppkey % 730 AS INT)) AS join_date",
        "CASE WHEN s_acctbal < 0 THEN 'False' ELSE 'True' END AS is_active",
    )


def rides(spark: SparkSession, directory: str) -> DataFrame:
    lines = load(spark, directory, "lineitem")
    orders = load(spark, directory, "orders")
    city = _city("l_suppkey")
    status = ("CASE WHEN l_returnflag = 'A' OR (l_returnflag = 'N' AND l_linestatus = 'F') THEN 'completed' "
              "WHEN l_returnflag = 'N' THEN 'ongoing' WHEN l_linestatus = 'F' THEN 'cancelled' ELSE 'no_show' END")
    base = (
        lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        .selectExpr("*", f"{city} AS clean_city", f"{status} AS ride_status",
                    "o_orderdate + make_dt_interval(0, 0, 0, l_partkey * 37 % 86400) AS request_time")
    )
    return base.selectExpr(
        "concat('R', l_orderkey, '-', l_linenumber) AS ride_id",
        _padded("C", "o_custkey", 7) + " AS customer_id",
        _padded("D", "l_suppkey", 5) + " AS driver_id",
        "CASE l_partkey % 33 WHEN 0 THEN lower(clean_city) WHEN 1 THEN upper(clean_city) "
        "WHEN 2 THEN concat(clean_city, ' ') WHEN 3 THEN CASE clean_city WHEN 'Bangalore' THEN 'Bengaluru' "
        "WHEN 'Delhi' THEN 'New Delhi' ELSE clean_city END ELSE clean_city END AS pickup_city",
        "concat('Area ', l_partkey % 10) AS pickup_area",
        _city("o_custkey") + " AS dropoff_city",
        "concat('Area ', o_custkey % 10) AS dropoff_area",
        "CAST(CASE WHEN l_partkey % 211 = 7 THEN 190.0 ELSE 18.9 + (l_orderkey % 350) * 0.001 END "
        "AS DECIMAL(10,6)) AS pickup_lat",
        "CAST(72.77 + (l_suppkey % 200) * 0.001 AS DECIMAL(10,6)) AS pickup_lon",
        "CAST(18.9 + (o_custkey % 350) * 0.001 AS DECIMAL(10,6)) AS dropoff_lat",
        "CAST(72.77 + (l_partkey % 200) * 0.001 AS DECIMAL(10,6)) AS dropoff_lon",
        "request_time",
        "CASE WHEN ride_status IN ('completed', 'ongoing') OR (ride_status = 'cancelled' AND l_partkey % 2 = 0) "
        "THEN request_time + make_dt_interval(0, 0, CAST(l_partkey % 14 + 2 AS INT)) END AS pickup_time",
        "CASE WHEN ride_status = 'completed' THEN request_time + make_dt_interval(0, 0, "
        "CASE WHEN l_partkey % 97 = 5 THEN 1 ELSE CAST(l_partkey % 14 + 7 + l_quantity AS INT) END) END AS dropoff_time",
        "CAST(CASE WHEN l_partkey % 50 = 0 THEN -l_quantity ELSE l_quantity END AS DECIMAL(12,2)) AS distance_km",
        "CAST(CASE WHEN l_partkey % 100 = 1 THEN 0 ELSE l_extendedprice END AS DECIMAL(12,2)) AS fare",
        "CAST(1.0 + CAST(l_discount AS DECIMAL(4,2)) * 15 AS DECIMAL(4,2)) AS surge_multiplier",
        "ride_status",
    )


def payments(spark: SparkSession, directory: str) -> DataFrame:
    return load(spark, directory, "orders").selectExpr(
        "concat('P', o_orderkey) AS payment_id",
        "concat('R', o_orderkey, '-1') AS ride_id",
        _padded("C", "o_custkey", 7) + " AS customer_id",
        "CAST(CASE WHEN o_orderkey % 101 = 0 THEN -1 ELSE o_totalprice END AS DECIMAL(12,2)) AS amount",
        "CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'UPI' WHEN '2' THEN 'Credit Card' "
        "WHEN '3' THEN 'Debit Card' WHEN '4' THEN 'Cash' ELSE 'Wallet' END AS payment_method",
        "CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' "
        "ELSE CASE WHEN o_orderkey % 4 = 0 THEN 'refunded' ELSE 'failed' END END AS payment_status",
        "o_orderdate AS payment_time",
        "CAST(CASE WHEN o_orderkey % 5 = 0 THEN o_orderkey % 91 + 10 ELSE 0 END AS DECIMAL(12,2)) AS tip_amount",
    )


def ride_events(spark: SparkSession, directory: str) -> DataFrame:
    return load(spark, directory, "events")


def tables(spark: SparkSession, directory: str) -> dict[str, DataFrame]:
    return {
        "customers": customers(spark, directory),
        "drivers": drivers(spark, directory),
        "rides": rides(spark, directory),
        "payments": payments(spark, directory),
    }


def as_text(df: DataFrame) -> DataFrame:
    """The raw form of a dataset: every column as text."""
    return df.select([F.col(c).cast("string").alias(c) for c in df.columns])
