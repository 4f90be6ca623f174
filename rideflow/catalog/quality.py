"""Rules, cascading load, reports, alerts and checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from rideflow import schemas
from rideflow.catalog import stores
from rideflow.catalog.accepted_sql import DRIVER_LIMITS, PAYMENT_REASONS, REASONS, RIDE_REASONS, accepted, silver
from rideflow.catalog.mapping_sql import percent, with_tables
from rideflow.catalog.registry import query
from rideflow.operators import quality, reconcile
from rideflow.operators import silver as steps
from rideflow.operators.ranking import daily_counts
from rideflow.operators.stats import drift, profile
from rideflow.plans import lake, load
from rideflow.sources.testdata import as_text, customers, drivers, payments, ride_events, rides


def _union(frames):
    result = None
    for f in frames:
        result = f if result is None else result.unionByName(f)
    return result


@query("dq_01_reasons_per_row", with_tables("customers rides", """
SELECT ride_id, list_aggregate(list_sort(list_filter([
    CASE WHEN distance_km >= 0 THEN NULL ELSE 'NEGATIVE_DISTANCE' END, CASE WHEN fare >= 0 THEN NULL ELSE 'NEGATIVE_FARE' END,
    CASE WHEN surge_multiplier >= 1.0 THEN NULL ELSE 'INVALID_SURGE' END,
    CASE WHEN pickup_lat BETWEEN -90 AND 90 THEN NULL ELSE 'INVALID_COORDINATES' END,
    CASE WHEN dropoff_time < pickup_time THEN 'INVALID_TIMESTAMPS' END,
    CASE WHEN fare = 0 THEN 'ZERO_FARE' END,
    CASE WHEN length(ride_id) > 10 THEN 'STRING_TOO_LONG' END], lambda x: x IS NOT NULL)), 'string_agg', ',') AS reasons
FROM rides WHERE distance_km < 0 OR fare <= 0 OR surge_multiplier < 1 OR pickup_lat > 90 OR dropoff_time < pickup_time
  OR length(ride_id) > 10"""))
def _(spark, d):
    judged = quality.evaluate(stores.staged(spark, d)["rides"], quality.silver_rules("rides"))
    codes = F.array_sort(F.array_distinct(F.transform("failures", lambda x: x["code"])))
    return quality.rejected(judged).select("ride_id", F.array_join(codes, ",").alias("reasons"))


@query("dq_02_split", accepted("""
SELECT 'valid' AS side, count(*) AS rows, sum(rating)::DECIMAL(18,1) AS rating FROM drivers_ok
UNION ALL SELECT 'quarantine', count(*), sum(rating)::DECIMAL(18,1) FROM drivers
WHERE driver_id NOT IN (SELECT driver_id FROM drivers_ok)"""))
def _(spark, d):
    valid, bad = quality.split(drivers(spark, d), quality.LOAD_RULES["drivers"], (), quality.unique_rules("drivers"))
    return _union(f.agg(F.lit(side).alias("side"), F.count("*").alias("rows"),
                        F.sum("rating").cast("decimal(18,1)").alias("rating"))
                  for side, f in (("valid", valid), ("quarantine", bad)))


@query("dq_03_quarantine", accepted("""
SELECT 'DUPLICATE_EMAIL' AS error_code, 'email already belongs to an earlier id' AS error_message, customer_id,
  'customers.csv' AS source_file, 'run-1' AS pipeline_run_id, TIMESTAMP '2026-09-01 08:15:00' AS quarantined_at, '2026-09-01' AS dt
FROM customers WHERE customer_id NOT IN (SELECT customer_id FROM customers_ok)"""))
def _(spark, d):
    judged = quality.evaluate(load.typed(customers(spark, d)), quality.LOAD_RULES["customers"], (), quality.unique_rules("customers"))
    records = quality.quarantine(judged, "customers.csv", "run-1", "2026-09-01 08:15:00")
    return records.withColumn("customer_id", F.get_json_object("raw_record", "$.customer_id")).drop("raw_record")


@query("dq_04_cascading_load", accepted("""
SELECT 'customers' AS table_name, customer_id AS key, 'accepted' AS state FROM customers_ok
UNION ALL SELECT 'drivers', driver_id, 'accepted' FROM drivers_ok
UNION ALL SELECT 'rides', ride_id, 'accepted' FROM rides_ok
UNION ALL SELECT 'payments', payment_id, 'accepted' FROM payments_ok"""))
def _(spark, d):
    frames = stores.evaluated(spark, d)
    return _union(quality.accepted(df).select(
        F.lit(n).alias("table_name"), F.col(schemas.PRIMARY_KEYS[n]).alias("key"), F.lit("accepted").alias("state"))
        for n, df in frames.items())


@query("dq_04_accepted_rides", accepted("""
SELECT ride_id, customer_id, driver_id, pickup_city, request_time, distance_km, fare FROM rides_ok"""))
def _(spark, d):
    return (quality.accepted(stores.evaluated(spark, d)["rides"])
            .select("ride_id", "customer_id", "driver_id", "pickup_city", "request_time", "distance_km", "fare"))


@query("dq_05_load_report", accepted("""
SELECT table_name, s AS rows_staged, l AS rows_loaded, s - l AS rows_rejected FROM (
  SELECT 'customers' AS table_name, (SELECT count(*) FROM customers) AS s, (SELECT count(*) FROM customers_ok) AS l
  UNION ALL SELECT 'drivers', (SELECT count(*) FROM drivers), (SELECT count(*) FROM drivers_ok)
  UNION ALL SELECT 'rides', (SELECT count(*) FROM rides), (SELECT count(*) FROM rides_ok)
  UNION ALL SELECT 'payments', (SELECT count(*) FROM payments), (SELECT count(*) FROM payments_ok))"""))
def _(spark, d):
    return load.reports(stores.evaluated(spark, d)).drop("rejection_reasons")


@query("ag_12_reasons_in_one_pass", accepted(
    "SELECT table_name, reason, rows FROM reasons WHERE rows > 0", RIDE_REASONS, PAYMENT_REASONS, REASONS))
def _(spark, d):
    return load.reports(stores.evaluated(spark, d)).select("table_name", F.explode("rejection_reasons").alias("reason", "rows"))


@query("dq_05_legacy_reasons", accepted("""
SELECT * FROM (
  SELECT 'customers' AS table_name, 'duplicate_email' AS reason, count(*) AS rows FROM customers
    WHERE email IN (SELECT email FROM customers GROUP BY email HAVING count(*) > 1)
  UNION ALL SELECT 'drivers', 'duplicate_license', count(*) FROM drivers
    WHERE license_number IN (SELECT license_number FROM drivers GROUP BY license_number HAVING count(*) > 1)
  UNION ALL SELECT 'drivers', 'invalid_rating', count(*) FROM drivers WHERE rating < 1.0 OR rating > 5.0
  UNION ALL SELECT 'rides', 'negative_distance', count(*) FROM rides WHERE distance_km < 0
  UNION ALL SELECT 'rides', 'zero_fare', count(*) FROM rides WHERE fare = 0 AND ride_status = 'completed'
  UNION ALL SELECT 'rides', 'orphan_customer', count(*) FROM rides WHERE customer_id NOT IN (SELECT customer_id FROM customers_ok)
  UNION ALL SELECT 'rides', 'orphan_driver', count(*) FROM rides WHERE driver_id NOT IN (SELECT driver_id FROM drivers_ok)
  UNION ALL SELECT 'payments', 'negative_amount', count(*) FROM payments WHERE amount < 0
  UNION ALL SELECT 'payments', 'orphan_ride', count(*) FROM payments WHERE ride_id NOT IN (SELECT ride_id FROM rides_ok)
  UNION ALL SELECT 'payments', 'orphan_customer', count(*) FROM payments WHERE customer_id NOT IN (SELECT customer_id FROM customers_ok)
) WHERE rows > 0"""))
def _(spark, d):
    # judging stored every row with the values that the reasons ask for, so the datasets are read from there
    judged = stores.evaluated(spark, d)
    loaded = {n: quality.accepted(df) for n, df in judged.items()}
    frames = {n: df.drop("failures", "warnings", "_ok") for n, df in judged.items()}
    return _union(load.legacy_reasons(frames, loaded, n) for n in frames)


@query("snk_13_row_counts", accepted("""
SELECT 'customers' AS table_name, count(*) AS rows FROM customers_ok UNION ALL SELECT 'drivers', count(*) FROM drivers_ok
UNION ALL SELECT 'rides', count(*) FROM rides_ok UNION ALL SELECT 'payments', count(*) FROM payments_ok"""))
def _(spark, d):
    from rideflow.sources.maintenance import row_counts
    return row_counts({n: df.filter("_ok") for n, df in stores.evaluated(spark, d).items()})


def _rate(part, whole):
    return percent(part, whole, 2)


@query("dq_06_quality_report", accepted(f"""
SELECT 'rides' AS dataset, n AS total_rows, {_rate('n - ok', 'n')} AS rejection_rate_pct,
  {_rate('passed - ok', 'n')} AS duplicate_rate_pct, {_rate('0', 'n')} AS null_pk_rate_pct,
  {_rate('nulls', 'n * 2')} AS null_rate_pct, {_rate('n - orphans', 'n')} AS fk_pass_rate_pct
FROM (SELECT (SELECT count(*) FROM rides) AS n, (SELECT count(*) FROM rides_ok) AS ok, (SELECT count(*) FROM rides_passed) AS passed,
  (SELECT count(*) FILTER (pickup_time IS NULL) + count(*) FILTER (dropoff_time IS NULL) FROM rides) AS nulls,
  (SELECT count(*) FROM rides WHERE customer_id NOT IN (SELECT customer_id FROM customers_ok)
     OR driver_id NOT IN (SELECT driver_id FROM drivers_ok)) AS orphans)"""))
def _(spark, d):
    judged = stores.evaluated(spark, d)["rides"]
    return quality.quality_report(judged, "rides", "ride_id", ["pickup_time", "dropoff_time"], ["ORPHAN_CUSTOMER", "ORPHAN_DRIVER"])


@query("dq_07_alerts", accepted(f"""
SELECT dataset, metric, value, CASE WHEN metric = 'rejection_rate_pct' AND value > 15 THEN 'critical'
    WHEN metric = 'rejection_rate_pct' AND value > 5 THEN 'warning' WHEN metric = 'duplicate_rate_pct' AND value > 2 THEN 'critical'
    WHEN metric = 'duplicate_rate_pct' AND value > 0.5 THEN 'warning' WHEN metric = 'null_pk_rate_pct' AND value > 0 THEN 'warning'
    ELSE 'ok' END AS level
FROM (
  SELECT 'rides' AS dataset, 'rejection_rate_pct' AS metric, {_rate('n - ok', 'n')} AS value FROM ride_totals
  UNION ALL SELECT 'rides', 'duplicate_rate_pct', {_rate('passed - ok', 'n')} FROM ride_totals
  UNION ALL SELECT 'rides', 'null_pk_rate_pct', 0.00::DECIMAL(18,2)
  UNION ALL SELECT 'customers', 'rejection_rate_pct', {_rate('n - ok', 'n')} FROM customer_totals
  UNION ALL SELECT 'customers', 'duplicate_rate_pct', {_rate('n - ok', 'n')} FROM customer_totals
  UNION ALL SELECT 'customers', 'null_pk_rate_pct', 0.00::DECIMAL(18,2))""",
    """ride_totals AS (SELECT (SELECT count(*) FROM rides) AS n, (SELECT count(*) FROM rides_ok) AS ok,
  (SELECT count(*) FROM rides_passed) AS passed)""",
    "customer_totals AS (SELECT (SELECT count(*) FROM customers) AS n, (SELECT count(*) FROM customers_ok) AS ok)"))
def _(spark, d):
    frames = stores.evaluated(spark, d)
    reports = _union(quality.quality_report(frames[n], n, schemas.PRIMARY_KEYS[n], [schemas.PRIMARY_KEYS[n]], [])
                     for n in ("rides", "customers"))
    return quality.alerts(quality.rate_metrics(reports))


def _alert_sql(dataset: str, table: str, passed: str, ok: str) -> str:
    totals = f"(SELECT (SELECT count(*) FROM {table}) AS n, (SELECT count(*) FROM {ok}) AS ok, (SELECT count(*) FROM {passed}) AS passed)"
    return (f"SELECT '{dataset}' AS dataset, 'rejection_rate_pct' AS metric, {_rate('n - ok', 'n')} AS value FROM {totals} "
            f"UNION ALL SELECT '{dataset}', 'duplicate_rate_pct', {_rate('passed - ok', 'n')} FROM {totals} "
            f"UNION ALL SELECT '{dataset}', 'null_pk_rate_pct', {_rate('0', 'n')} FROM {totals}")


@query("dq_07_alerts_all", accepted(f"""
SELECT dataset, metric, value, CASE WHEN metric = 'rejection_rate_pct' AND value > 15 THEN 'critical'
    WHEN metric = 'rejection_rate_pct' AND value > 5 THEN 'warning' WHEN metric = 'duplicate_rate_pct' AND value > 2 THEN 'critical'
    WHEN metric = 'duplicate_rate_pct' AND value > 0.5 THEN 'warning' WHEN metric = 'null_pk_rate_pct' AND value > 0 THEN 'warning'
    ELSE 'ok' END AS level
FROM ({_alert_sql('customers', 'customers', 'customers', 'customers_ok')} UNION ALL {_alert_sql('drivers', 'drivers', 'drivers_passed', 'drivers_ok')}
  UNION ALL {_alert_sql('rides', 'rides', 'rides_passed', 'rides_ok')} UNION ALL {_alert_sql('payments', 'payments', 'payments_ok', 'payments_ok')})""",
    f"drivers_passed AS (SELECT * FROM drivers WHERE {DRIVER_LIMITS})"))
def _(spark, d):
    frames = stores.evaluated(spark, d)
    reports = _union(quality.quality_report(df, n, schemas.PRIMARY_KEYS[n], [schemas.PRIMARY_KEYS[n]], []) for n, df in frames.items())
    return quality.alerts(quality.rate_metrics(reports))


# Values outside of the allowed ones are put into every column that has a list of them, and NULLs into some.
@query("dq_01_seeded_values", with_tables("drivers rides payments", """
SELECT 'drivers' AS dataset, 'INVALID_VEHICLE_TYPE' AS code, count(*) AS rows FROM drivers WHERE vehicle_type = 'Bike' OR city = 'Pune'
UNION ALL SELECT 'rides', 'INVALID_RIDE_STATUS', count(*) FROM rides WHERE ride_status = 'no_show' OR pickup_area = 'Area 3'
UNION ALL SELECT 'rides', 'NEGATIVE_FARE', count(*) FROM rides WHERE pickup_city = 'Pune' AND fare >= 0 OR fare < 0
UNION ALL SELECT 'payments', 'INVALID_PAYMENT_METHOD', count(*) FROM payments WHERE payment_method = 'Cash'
UNION ALL SELECT 'payments', 'INVALID_PAYMENT_STATUS', count(*) FROM payments WHERE payment_status = 'failed' OR tip_amount = 0"""))
def _(spark, d):
    def seeded(column, condition, value):
        return F.when(F.expr(condition), F.lit(value)).otherwise(F.col(column))

    frames = stores.staged(spark, d)
    odd = {
        "drivers": frames["drivers"].withColumn("vehicle_type", F.when(F.col("city") == "Pune", F.lit(None)).otherwise(seeded("vehicle_type", "vehicle_type = 'Bike'", "bike"))),
        "rides": frames["rides"].withColumns({
            "ride_status": F.when(F.col("pickup_area") == "Area 3", F.lit(None)).otherwise(seeded("ride_status", "ride_status = 'no_show'", "gone")),
            "fare": F.when((F.col("pickup_city") == "Pune") & (F.col("fare") >= 0), -F.col("fare") - F.lit(1)).otherwise(F.col("fare")).cast("decimal(10,2)")}),
        "payments": frames["payments"].withColumns({
            "payment_method": seeded("payment_method", "payment_method = 'Cash'", "Cheque"),
            "payment_status": F.when(F.col("tip_amount") == 0, F.lit(None)).otherwise(seeded("payment_status", "payment_status = 'failed'", ""))})}
    codes = ("INVALID_VEHICLE_TYPE", "INVALID_RIDE_STATUS", "NEGATIVE_FARE", "INVALID_PAYMENT_METHOD", "INVALID_PAYMENT_STATUS")
    return _union(quality.evaluate(df, quality.LOAD_RULES[n]).select(F.lit(n).alias("dataset"), F.explode(F.array_distinct(F.transform("failures", lambda x: x["code"]))).alias("code"))
                  .where(F.col("code").isin(*codes)).groupBy("dataset", "code").agg(F.count("*").alias("rows")) for n, df in odd.items())


@query("dq_07_volume_alerts", """
WITH daily AS (
  SELECT day::DATE AS day, count(event_id) AS n
  FROM (SELECT unnest(generate_series(min(ts)::DATE, max(ts)::DATE, INTERVAL 1 DAY)) AS day FROM events)
  LEFT JOIN events ON ts::DATE = day::DATE GROUP BY 1),
rolled AS (SELECT day, n, ((2 * 100 * s + k) // nullif(2 * k, 0) * 0.01)::DECIMAL(18,2) AS avg FROM (
  SELECT day, n, (sum(n) OVER w)::HUGEINT AS s, count(*) OVER w AS k FROM daily
  WINDOW w AS (ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)))
SELECT dataset, metric, value, CASE WHEN value > 60 THEN 'critical' WHEN value > 30 THEN 'warning' ELSE 'ok' END AS level
FROM (SELECT day::VARCHAR AS dataset, 'volume_drop_pct' AS metric,
  greatest(round(100 * (avg - n) / avg, 2)::DECIMAL(18,2), 0) AS value FROM rolled)""")
def _(spark, d):
    return quality.alerts(quality.volume_drop(daily_counts(ride_events(spark, d), "ts")))


@query("dq_08_assertion_counts", silver("""
SELECT count(*) AS row_count, count(*) FILTER (NOT fare > 0) AS no_negative_fare, count(*) FILTER (ride_id IS NULL) AS no_null_key,
  count(*) FILTER (distance_km < 0) AS no_negative_distance FROM silver_rides"""))
def _(spark, d):
    return quality.check_counts(stores.silver(spark, d)["rides"], lake.POST_SILVER_CHECKS)


# Keys and names are spoilt where the SQL can tell: each check of Gold has to find them.
@query("dq_08_gold_checks", silver("""
SELECT 'fact_rides' AS dataset, unnest(['customer_key', 'driver_key', 'location_key', 'date_key', 'driver_version', 'customer_version']) AS check_name,
  unnest([n1, n2, n3, n4, n5, n6]) AS rows FROM (SELECT count(*) FILTER (ride_status = 'completed') AS n1, count(*) FILTER (fare > 100) AS n2,
    count(*) FILTER (month(request_time) = 6) AS n3, count(*) FILTER (surge_multiplier > 1) AS n4, count(*) FILTER (distance_km > 5) AS n5,
    count(*) FILTER (ride_status = 'no_show') AS n6 FROM silver_rides)
UNION ALL SELECT 'dim_customer', 'no_raw_email', count(*) FILTER (city = 'Pune') FROM silver_customers"""))
def _(spark, d):
    g = stores.gold(spark, d)
    spoilt = {"customer_key": "ride_status = 'completed'", "driver_key": "fare > 100", "location_key": "month = 6", "date_key": "surge_multiplier > 1",
              "driver_version": "distance_km > 5", "customer_version": "ride_status = 'no_show'"}
    odd = {"fact_rides": g["fact_rides"].withColumns({c: F.when(~F.expr(p), F.col(c)) for c, p in spoilt.items()}),
           "dim_customer": g["dim_customer"].withColumn("customer_name", F.when(F.col("city") == "Pune", "a@b").otherwise(F.col("customer_name")))}
    return _union(quality.check_counts(odd[name], checks).unpivot([], list(checks), "check_name", "rows").select(F.lit(name).alias("dataset"), "check_name", "rows")
                  for name, checks in lake.POST_GOLD_CHECKS.items())


@query("dq_10_reconcile_counts", accepted("""
SELECT (SELECT count(*) FROM rides) AS input, (SELECT count(*) FROM rides_ok) AS valid,
  (SELECT count(*) FROM rides) - (SELECT count(*) FROM rides_ok) AS rejected, true AS balanced"""))
def _(spark, d):
    judged = stores.evaluated(spark, d)["rides"]
    return quality.reconcile_counts({"input": rides(spark, d), "valid": judged.filter("_ok"), "rejected": judged.filter("NOT _ok")})


@query("dq_11_freshness", with_tables("rides payments", """
SELECT 'rides' AS dataset, max(request_time) AS newest, date_sub('hour', max(request_time), TIMESTAMP '2002-01-01 00:00:00') AS age_hours FROM rides
UNION ALL SELECT 'payments', max(payment_time), date_sub('hour', max(payment_time), TIMESTAMP '2002-01-01 00:00:00') FROM payments"""))
def _(spark, d):
    now = "2002-01-01 00:00:00"
    return _union([quality.freshness(rides(spark, d), "request_time", now, "rides"),
                   quality.freshness(payments(spark, d), "payment_time", now, "payments")])


@query("dq_12_payment_mismatch", accepted("""
SELECT coalesce(r.ride_id, p.ride_id) AS ride_id, r.fare::DECIMAL(18,2) AS fare, p.paid::DECIMAL(18,2) AS paid, p.n AS payments,
  CASE WHEN r.ride_id IS NULL THEN 'missing_ride' WHEN r.done AND p.ride_id IS NULL THEN 'missing_payment' ELSE 'amount_mismatch' END AS finding
FROM (SELECT ride_id, min(fare) AS fare, bool_or(ride_status = 'completed') AS done FROM rides_ok GROUP BY ride_id) r
FULL JOIN (SELECT ride_id, count(*) AS n, sum(amount) FILTER (payment_status = 'completed') AS paid FROM payments_ok GROUP BY ride_id) p
  ON r.ride_id = p.ride_id
WHERE r.ride_id IS NULL OR (r.done AND p.ride_id IS NULL) OR (r.done AND p.paid <> r.fare)"""))
def _(spark, d):
    frames = {n: df.filter("_ok") for n, df in stores.evaluated(spark, d).items()}
    report = reconcile.reconcile_payments(frames["rides"], frames["payments"])
    return (report.filter("finding <> 'ok'")
            .withColumns({"fare": F.col("fare").cast("decimal(18,2)"), "paid": F.col("paid").cast("decimal(18,2)")}))


@query("dq_14_contract", silver("""
SELECT 'rides' AS dataset, 0 AS problems UNION ALL SELECT 'payments', 0 UNION ALL SELECT 'drivers', 0 UNION ALL SELECT 'customers', 0"""))
def _(spark, d):
    """Rows that passed the cast and the rules must have exactly the declared columns and types."""
    found = []
    for name, df in stores.staged(spark, d).items():
        valid, _bad = quality.split(steps.clean(as_text(df), name), quality.silver_rules(name))
        found.append((name, len(quality.check_contract(valid, schemas.DATASETS[name]))))
    return spark.createDataFrame(found, "dataset string, problems int")


# A column that is missing, one of another type, one too many, and NULLs that the schema forbids.
@query("dq_14_contract_drift", with_tables("customers rides payments", """
SELECT 'rides' AS dataset, 'missing column surge_multiplier' AS problem UNION ALL SELECT 'rides', 'fare is string, expected decimal(10,2)'
UNION ALL SELECT 'payments', 'unexpected column channel'
UNION ALL SELECT 'payments', 'amount has ' || count(*) || ' nulls' FROM payments WHERE payment_method = 'Cash' HAVING count(*) > 0
UNION ALL SELECT 'customers', 'email has ' || count(*) || ' nulls' FROM customers WHERE city = 'Pune' HAVING count(*) > 0"""))
def _(spark, d):
    frames = stores.staged(spark, d)
    typed = {n: quality.split(steps.clean(as_text(frames[n]), n), ())[0] for n in ("customers", "rides", "payments")}
    drifted = {
        "customers": typed["customers"].withColumn("email", F.when(F.col("city") != "Pune", F.col("email"))),
        "rides": typed["rides"].drop("surge_multiplier").withColumn("fare", F.col("fare").cast("string")),
        "payments": typed["payments"].withColumn("channel", F.lit("app")).withColumn("amount", F.when(F.col("payment_method") != "Cash", F.col("amount")))}
    found = [(n, problem) for n, df in drifted.items() for problem in quality.check_contract(df, schemas.DATASETS[n])]
    return spark.createDataFrame(found, "dataset string, problem string")


@query("dq_15_drift", with_tables("payments", f"""
SELECT period, category, n, share_pct, (share_pct - lag(share_pct) OVER (PARTITION BY category ORDER BY period))::DECIMAL(18,2) AS change_pct
FROM (SELECT period, category, n, {percent('n', '(sum(n) OVER (PARTITION BY period))::HUGEINT', 2)} AS share_pct
  FROM (SELECT date_trunc('month', payment_time)::DATE AS period, payment_method AS category, count(*) AS n FROM payments GROUP BY 1, 2))"""))
def _(spark, d):
    monthly = payments(spark, d).withColumn("month", F.trunc(F.to_date("payment_time"), "month"))
    return drift(monthly, "payment_method", "month")


def _profile_sql():
    cats = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {c} AS statistic, count(*)::DECIMAL(18,2) AS value FROM rides GROUP BY {c}"
        for c in ("ride_status", "pickup_area"))
    from rideflow.catalog.mapping_sql import mean
    stats = " UNION ALL ".join(
        f"SELECT '{m}', '{s}', ({e})::DECIMAL(18,2) FROM rides"
        for m in ("distance_km", "fare")
        for s, e in (("count", f"count({m})"), ("min", f"min({m})"), ("max", f"max({m})"), ("mean", mean(m)),
                     ("negative", f"count(*) FILTER ({m} < 0)"), ("zero", f"count(*) FILTER ({m} = 0)")))
    return cats + " UNION ALL " + stats


@query("dq_16_profile", with_tables("rides", _profile_sql()))
def _(spark, d):
    return profile(rides(spark, d), ["ride_status", "pickup_area"], ["distance_km", "fare"])
