"""Scalar functions, masks and cells."""

from __future__ import annotations

from pyspark.sql import functions as F

from rideflow import schemas
from rideflow.catalog.mapping_sql import clean_city, with_tables
from rideflow.catalog.registry import query
from rideflow.functions import geo, keys, text, times
from rideflow.functions.keys import salted_hash, surrogate_key
from rideflow.operators import privacy
from rideflow.sources.testdata import customers, drivers, payments, ride_events, rides, tables

SALT = "pepper-2024"


@query("fn_01_hour", "SELECT event_id, hour(ts)::INT AS hour FROM events")
def _(spark, d):
    return ride_events(spark, d).select("event_id", F.hour("ts").alias("hour"))


@query("fn_02_truncate", "SELECT event_id, date_trunc('month', ts)::DATE AS month, ts::DATE AS day FROM events")
def _(spark, d):
    return ride_events(spark, d).select("event_id", times.month_start("ts").alias("month"), F.to_date("ts").alias("day"))


@query("fn_03_calendar_parts", with_tables("rides", """
SELECT ride_id, request_time::DATE AS ride_date, hour(request_time)::INT AS ride_hour,
  (dayofweek(request_time) + 1)::INT AS day_of_week, month(request_time)::INT AS month, year(request_time)::INT AS year
FROM rides"""))
def _(spark, d):
    parts = times.calendar_parts("request_time")
    return rides(spark, d).select("ride_id", *[c.alias(n) for n, c in parts.items()])


@query("fn_04_durations", with_tables("rides", """
SELECT ride_id, ride_status, date_sub('minute', request_time, pickup_time) AS wait_minutes,
  date_sub('minute', pickup_time, dropoff_time) AS trip_minutes FROM rides"""))
def _(spark, d):
    return rides(spark, d).select("ride_id", "ride_status",
                                  times.minutes_between("request_time", "pickup_time").alias("wait_minutes"),
                                  times.minutes_between("pickup_time", "dropoff_time").alias("trip_minutes"))


@query("fn_05_round_half_up", with_tables("rides", """
SELECT ride_id, fare, round(fare * 0.05, 2)::DECIMAL(18,2) AS fee, round(distance_km * 0.125, 2)::DECIMAL(18,2) AS points
FROM rides"""))
def _(spark, d):
    return rides(spark, d).select(
        "ride_id", "fare",
        F.round(F.col("fare") * F.lit("0.05").cast("decimal(3,2)"), 2).cast("decimal(18,2)").alias("fee"),
        F.round(F.col("distance_km") * F.lit("0.125").cast("decimal(4,3)"), 2).cast("decimal(18,2)").alias("points"))


_TS_TEXT = ("CASE event_type WHEN 'click' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') WHEN 'view' THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ') "
            "WHEN 'error' THEN 'not a time' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END")


@query("fn_06_parse", f"""
WITH raw AS (SELECT event_id, {_TS_TEXT} AS ts_text,
  CASE WHEN event_type = 'signup' THEN 'banana' ELSE value::DECIMAL(12,2)::VARCHAR END AS value_text FROM events)
SELECT event_id, TRY_CAST(replace(replace(ts_text, 'T', ' '), 'Z', '') AS TIMESTAMP) AS ts,
  TRY_CAST(value_text AS DECIMAL(12,2)) AS value FROM raw""")
def _(spark, d):
    raw = ride_events(spark, d).select(
        "event_id",
        F.when(F.col("event_type") == "click", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
        .when(F.col("event_type") == "view", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(F.col("event_type") == "error", "not a time")
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("ts_text"),
        F.when(F.col("event_type") == "signup", "banana").otherwise(F.col("value").cast("decimal(12,2)").cast("string")).alias("value_text"))
    return raw.select("event_id", times.parse_timestamp("ts_text").alias("ts"),
                      F.col("value_text").try_cast("decimal(12,2)").alias("value"))


@query("fn_07_city", with_tables("rides", f"""
SELECT pickup_city, {clean_city('pickup_city')} AS city, count(*) AS rides FROM rides GROUP BY ALL"""))
def _(spark, d):
    return (rides(spark, d).groupBy("pickup_city").agg(F.count("*").alias("rides"))
            .withColumn("city", text.clean_city(F.col("pickup_city"))))


@query("fn_08_substring", with_tables("customers", """
SELECT customer_id, substr(first_name, 1, 1) AS initial, right(phone, 4) AS tail, substr(email, 2, 3) AS middle FROM customers"""))
def _(spark, d):
    return customers(spark, d).select("customer_id", F.substring("first_name", 1, 1).alias("initial"),
                                      F.right("phone", F.lit(4)).alias("tail"), F.substring("email", 2, 3).alias("middle"))


@query("fn_09_salted_hash", with_tables("customers", f"SELECT customer_id, sha256(email || '{SALT}') AS email_hash FROM customers"))
def _(spark, d):
    return customers(spark, d).select("customer_id", salted_hash("email", SALT).alias("email_hash"))


@query("fn_10_md5", with_tables("payments", "SELECT payment_id, md5(payment_id || '|' || ride_id) AS checksum FROM payments"))
def _(spark, d):
    return payments(spark, d).select("payment_id", F.md5(F.concat("payment_id", F.lit("|"), "ride_id")).alias("checksum"))


@query("fn_11_regex_replace", with_tables("customers", r"""
SELECT customer_id, regexp_replace(email, '(^.).*(@.*$)', '\1***\2') AS email FROM customers"""))
def _(spark, d):
    return customers(spark, d).select("customer_id", text.email_partial("email").alias("email"))


@query("fn_12_to_json", with_tables("drivers", """
SELECT driver_id, '{"driver_id":"' || driver_id || '","city":"' || city || '","rating":' || rating::VARCHAR || '}' AS record
FROM drivers"""))
def _(spark, d):
    return drivers(spark, d).select("driver_id", F.to_json(F.struct("driver_id", "city", "rating")).alias("record"))


@query("fn_14_source_file", "SELECT 'events.parquet' AS file, count(*) AS rows FROM events")
def _(spark, d):
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    return ride_events(spark, d).groupBy(name.alias("file")).agg(F.count("*").alias("rows"))


@query("fn_15_calendar_flags", """
SELECT event_id, quarter(ts)::INT AS quarter, dayofweek(ts) IN (0, 6) AS is_weekend, day(ts)::INT AS day FROM events""")
def _(spark, d):
    return ride_events(spark, d).select("event_id", F.quarter("ts").alias("quarter"),
                                        times.is_weekend(F.to_date("ts")).alias("is_weekend"), F.dayofmonth("ts").alias("day"))


def _geohash_sql(lat, lon, precision=6):
    bits = 5 * precision
    lon_bits, lat_bits = (bits + 1) // 2, bits // 2
    lon_i = f"least(floor(({lon}::DOUBLE + 180.0) / 360.0 * {float(1 << lon_bits)})::BIGINT, {(1 << lon_bits) - 1})"
    lat_i = f"least(floor(({lat}::DOUBLE + 90.0) / 180.0 * {float(1 << lat_bits)})::BIGINT, {(1 << lat_bits) - 1})"
    chars = []
    for i in range(precision):
        terms = []
        for j in range(5):
            b = 5 * i + j
            source, shift = (lon_i, lon_bits - 1 - b // 2) if b % 2 == 0 else (lat_i, lat_bits - 1 - b // 2)
            terms.append(f"(({source} // {1 << shift}) % 2) * {1 << (4 - j)}")
        chars.append(f"substr('{geo.BASE32}', ({' + '.join(terms)} + 1)::INT, 1)")
    return (f"CASE WHEN {lat} BETWEEN -90 AND 90 AND {lon} BETWEEN -180 AND 180 THEN {' || '.join(chars)} END")


@query("geo_01_cell", with_tables("rides", f"""
SELECT ride_id, pickup_lat, {_geohash_sql('pickup_lat', 'pickup_lon')} AS cell,
  {_geohash_sql('dropoff_lat', 'dropoff_lon', 5)} AS coarse FROM rides"""))
def _(spark, d):
    return rides(spark, d).select("ride_id", "pickup_lat", geo.geo_cell("pickup_lat", "pickup_lon").alias("cell"),
                                  geo.geo_cell("dropoff_lat", "dropoff_lon", 5).alias("coarse"))


@query("pv_01_email_hash", with_tables("customers", f"""
SELECT customer_id, sha256(email || '{SALT}') AS email FROM customers"""))
def _(spark, d):
    return privacy.mask(customers(spark, d), schemas.CUSTOMERS, SALT).select("customer_id", "email")


@query("pv_02_phone", with_tables("customers", r"""
SELECT customer_id, '***-***-' || right(regexp_replace(phone, '\D', '', 'g'), 4) AS phone FROM customers"""))
def _(spark, d):
    return privacy.mask(customers(spark, d), schemas.CUSTOMERS, SALT).select("customer_id", "phone")


@query("pv_03_names", with_tables("drivers", """
SELECT driver_id, substr(first_name, 1, 1) || '***' AS first_name, substr(last_name, 1, 1) || '***' AS last_name FROM drivers"""))
def _(spark, d):
    return privacy.mask(drivers(spark, d), schemas.DRIVERS, SALT).select("driver_id", "first_name", "last_name")


@query("pv_04_license", with_tables("drivers", f"""
SELECT driver_id, sha256(license_number || '{SALT}') AS license_number FROM drivers"""))
def _(spark, d):
    return privacy.mask(drivers(spark, d), schemas.DRIVERS, SALT).select("driver_id", "license_number")


@query("pv_05_role_projection", with_tables("customers", r"""
SELECT 'data_protection_officer' AS role, customer_id, first_name, last_name, email, phone FROM customers
UNION ALL SELECT 'data_analyst', customer_id, substr(first_name, 1, 1) || '***', substr(last_name, 1, 1) || '***',
  regexp_replace(email, '(^.).*(@.*$)', '\1***\2'), '***-***-' || right(regexp_replace(phone, '\D', '', 'g'), 4) FROM customers"""))
def _(spark, d):
    def seen_by(role):
        shown = privacy.project_for_role(customers(spark, d), schemas.CUSTOMERS, role)
        return shown.select(F.lit(role).alias("role"), "customer_id", "first_name", "last_name", "email", "phone")
    return seen_by("data_protection_officer").unionByName(seen_by("data_analyst"))


@query("pv_06_row_filter", with_tables("customers", "SELECT customer_id, city FROM customers WHERE city = 'Pune'"))
def _(spark, d):
    return privacy.row_filter(customers(spark, d), "city", "Pune").select("customer_id", "city")


@query("pv_07_visible_frames", with_tables("rides payments drivers", """
SELECT 'bi_reader' AS role, 'v_hourly_demand' AS frame, count(*) AS rows FROM (SELECT DISTINCT hour(request_time), pickup_city FROM rides)
UNION ALL SELECT 'bi_reader', 'v_rides_by_city', count(*) FROM (SELECT DISTINCT pickup_city, ride_status FROM rides)
UNION ALL SELECT 'bi_reader', 'v_revenue_by_method', count(*) FROM (SELECT DISTINCT payment_method, payment_status FROM payments)
UNION ALL SELECT 'bi_reader', 'v_driver_performance', count(*) FROM (SELECT DISTINCT vehicle_type, city FROM drivers)"""))
def _(spark, d):
    from rideflow.plans.views import VIEWS
    from rideflow.sources.maintenance import row_counts

    t = tables(spark, d)
    frames = privacy.visible_frames("bi_reader", t, {n: v(t) for n, v in VIEWS.items()})
    return row_counts(frames).select(F.lit("bi_reader").alias("role"), F.col("table_name").alias("frame"), "rows")


@query("pv_08_k_anonymity", with_tables("customers", """
SELECT city, first_name, signup_date, count(*) AS group_size FROM customers GROUP BY ALL HAVING count(*) < 2"""))
def _(spark, d):
    return privacy.k_anonymity(customers(spark, d), ["city", "first_name", "signup_date"], 2)


_PII_ORACLE = {
    "email": "[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}",
    "phone": "\\+[0-9]{1,3}[ -]?[0-9]{10}",
    "card": "(^|[^0-9])[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}($|[^0-9])",
}


def _pii_sql(columns, kinds):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{k}' AS pattern, count(*) FILTER (regexp_matches({c}, '{p}')) AS hits FROM source"
        for c in columns for k, p in kinds.items())


@query("pv_09_pii_scan", with_tables(
    "customers", _pii_sql(["customer_id", "first_name", "last_name", "email", "phone", "city", "is_active"], _PII_ORACLE),
    "source AS (SELECT * FROM customers)"))
def _(spark, d):
    return privacy.pii_scan(customers(spark, d))


@query("pv_09_pii_scan_documents", "WITH source AS (SELECT * FROM documents) " + _pii_sql(["text", "lang", "source"], _PII_ORACLE))
def _(spark, d):
    from rideflow.sources.testdata import load
    return privacy.pii_scan(load(spark, d, "documents"))


_SUBJECTS = "subjects AS (SELECT customer_id FROM customers WHERE is_active = 'False')"


@query("pv_10_erase", with_tables("customers rides", """
SELECT ride_id, customer_id, fare FROM rides WHERE customer_id NOT IN (SELECT customer_id FROM subjects)""", _SUBJECTS))
def _(spark, d):
    gone = customers(spark, d).filter("is_active = 'False'")
    return privacy.erase(rides(spark, d), gone, "customer_id").select("ride_id", "customer_id", "fare")


@query("pv_11_subject_access", with_tables("customers rides payments", """
SELECT 'customers' AS table_name, customer_id, customer_id AS record FROM customers WHERE customer_id IN (SELECT customer_id FROM subjects)
UNION ALL SELECT 'rides', customer_id, ride_id FROM rides WHERE customer_id IN (SELECT customer_id FROM subjects)
UNION ALL SELECT 'payments', customer_id, payment_id FROM payments WHERE customer_id IN (SELECT customer_id FROM subjects)""", _SUBJECTS))
def _(spark, d):
    t = tables(spark, d)
    subjects = t["customers"].filter("is_active = 'False'")
    found = privacy.subject_access(t, subjects, "customer_id")
    result = None
    for name, df in found.items():
        one = df.select(F.lit(name).alias("table_name"), "customer_id", F.col(schemas.PRIMARY_KEYS[name]).alias("record"))
        result = one if result is None else result.unionByName(one)
    return result


@query("gd_01_surrogate_key", with_tables("customers", """
SELECT customer_id, ('0x' || substr(md5(customer_id), 1, 15))::BIGINT AS customer_key,
  ('0x' || substr(md5(city || '\\|' || '|' || first_name), 1, 15))::BIGINT AS group_key FROM customers"""))
def _(spark, d):
    return customers(spark, d).select("customer_id", surrogate_key("customer_id").alias("customer_key"),
                                      surrogate_key(F.concat("city", F.lit("|")), "first_name").alias("group_key"))


@query("gd_01_key_collisions", with_tables("rides", """
SELECT count(*) AS collisions FROM (SELECT 1 FROM (SELECT DISTINCT ride_id FROM rides)
GROUP BY substr(md5(ride_id), 1, 15) HAVING count(*) > 1)"""))
def _(spark, d):
    from rideflow.operators.gold import key_collisions
    return key_collisions(rides(spark, d), "ride_id").agg(F.count("*").alias("collisions"))


@query("fn_date_key", "SELECT event_id, strftime(ts, '%Y%m%d')::INT AS date_key FROM events")
def _(spark, d):
    return ride_events(spark, d).select("event_id", keys.date_key(F.col("ts")).alias("date_key"))
