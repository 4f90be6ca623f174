"""Projections, filters, joins, aggregations, windows, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from rideflow.catalog.mapping_sql import mean, percent, with_tables
from rideflow.catalog.registry import query
from rideflow.functions.numeric import mean as exact_mean
from rideflow.functions.numeric import percent as exact_percent
from rideflow.functions.numeric import total
from rideflow.functions.text import full_name
from rideflow.operators import reconcile
from rideflow.operators.dedupe import duplicated_keys, first_per_key, rows_with_duplicated_key
from rideflow.operators.quality import key_sketches, uniqueness, uniqueness_of
from rideflow.operators.ranking import daily_counts, ranked, rolling_mean, share_of_total
from rideflow.operators.stats import median_by
from rideflow.plans import kpis
from rideflow.sources.testdata import customers, drivers, load, payments, rides, tables
from rideflow.sources.workdir import materialize, work_dir

# --- projections ---------------------------------------------------------------------------------


@query("prj_01_select", with_tables("payments", "SELECT payment_id, amount AS paid_amount, ride_id FROM payments"))
def _(spark, d):
    return payments(spark, d).select("payment_id", F.col("amount").alias("paid_amount"), "ride_id")


@query("prj_02_cast", with_tables("payments", """
SELECT payment_id, round(amount, 0)::BIGINT AS amount_whole, payment_time::DATE AS payment_date,
  TRY_CAST(substr(payment_id, 2) AS BIGINT) AS payment_number, TRY_CAST(payment_method AS INT) AS not_a_number
FROM payments"""))
def _(spark, d):
    return payments(spark, d).select(
        "payment_id", F.round("amount", 0).cast("bigint").alias("amount_whole"),
        F.col("payment_time").cast("date").alias("payment_date"),
        F.substring("payment_id", 2, 20).try_cast("bigint").alias("payment_number"),
        F.col("payment_method").try_cast("int").alias("not_a_number"))


@query("prj_03_case", with_tables("customers", """
SELECT customer_id, CASE WHEN is_active = 'True' THEN true ELSE false END AS is_active FROM customers"""))
def _(spark, d):
    return customers(spark, d).select(
        "customer_id", F.when(F.col("is_active") == "True", True).otherwise(False).alias("is_active"))


@query("prj_04_concat", with_tables("drivers", """
SELECT driver_id, first_name || ' ' || last_name AS driver_name,
  nullif(vehicle_type, 'Bike') || ' ' || city AS vehicle_city FROM drivers"""))
def _(spark, d):
    return drivers(spark, d).select(
        "driver_id", full_name().alias("driver_name"),
        F.concat(F.nullif("vehicle_type", F.lit("Bike")), F.lit(" "), "city").alias("vehicle_city"))


@query("prj_05_arithmetic", with_tables("rides", f"""
SELECT pickup_city, (sum(fare) - min(fare))::DECIMAL(18,2) AS fare_without_lowest,
  (max(fare) - min(fare))::DECIMAL(18,2) AS fare_span,
  {percent("count(*) FILTER (ride_status = 'no_show')", 'count(*)')} AS no_show_pct
FROM rides GROUP BY pickup_city"""))
def _(spark, d):
    return rides(spark, d).groupBy("pickup_city").agg(
        (F.sum("fare") - F.min("fare")).cast("decimal(18,2)").alias("fare_without_lowest"),
        (F.max("fare") - F.min("fare")).cast("decimal(18,2)").alias("fare_span"),
        exact_percent(F.count_if(F.col("ride_status") == "no_show"), F.count("*")).alias("no_show_pct"))


@query("prj_06_default", with_tables("rides", """
SELECT ride_id, request_time, coalesce(dropoff_time, pickup_time, request_time) AS last_time,
  coalesce(nullif(surge_multiplier, 1.30), 1.00)::DECIMAL(4,2) AS surge FROM rides"""))
def _(spark, d):
    return rides(spark, d).select(
        "ride_id", "request_time", F.coalesce("dropoff_time", "pickup_time", "request_time").alias("last_time"),
        F.coalesce(F.nullif("surge_multiplier", F.lit("1.30").cast("decimal(4,2)")), F.lit("1.00").cast("decimal(4,2)"))
        .cast("decimal(4,2)").alias("surge"))


# --- filters -------------------------------------------------------------------------------------


@query("flt_01_comparison", with_tables("drivers", """
SELECT driver_id, rating FROM drivers WHERE rating >= 2.0 AND rating <= 4.0"""))
def _(spark, d):
    return drivers(spark, d).filter(F.col("rating").between(2.0, 4.0)).select("driver_id", "rating")


@query("flt_02_in_list", with_tables("payments", """
SELECT payment_id, payment_method, payment_status FROM payments
WHERE payment_method IN ('UPI', 'Wallet') AND payment_status NOT IN ('failed', 'refunded')"""))
def _(spark, d):
    return (payments(spark, d)
            .filter(F.col("payment_method").isin("UPI", "Wallet") & ~F.col("payment_status").isin("failed", "refunded"))
            .select("payment_id", "payment_method", "payment_status"))


@query("flt_03_is_null", with_tables("rides", """
SELECT ride_status, count(*) AS rides FROM rides WHERE pickup_time IS NOT NULL AND dropoff_time IS NULL
GROUP BY ride_status"""))
def _(spark, d):
    return (rides(spark, d).filter(F.col("pickup_time").isNotNull() & F.col("dropoff_time").isNull())
            .groupBy("ride_status").agg(F.count("*").alias("rides")))


@query("flt_04_three_valued", with_tables("rides", """
SELECT ride_id, distance_km, fare FROM rides
WHERE distance_km >= 0 AND fare >= 0 AND dropoff_time > pickup_time"""))
def _(spark, d):
    return (rides(spark, d)
            .filter((F.col("distance_km") >= 0) & (F.col("fare") >= 0) & (F.col("dropoff_time") > F.col("pickup_time")))
            .select("ride_id", "distance_km", "fare"))


@query("flt_05_compound_reason", with_tables("rides", """
SELECT ride_id, pickup_city, request_time FROM rides WHERE fare = 0 AND ride_status = 'completed'"""))
def _(spark, d):
    return (rides(spark, d).filter((F.col("fare") == 0) & (F.col("ride_status") == "completed"))
            .select("ride_id", "pickup_city", "request_time"))


@query("flt_06_like", with_tables("customers", """
SELECT count(*) FILTER (email LIKE '%@%') AS with_at, count(*) FILTER (last_name LIKE '%@%') AS names_with_at,
  count(*) FILTER (phone LIKE '+91 %00') AS round_phones FROM customers"""))
def _(spark, d):
    return customers(spark, d).agg(
        F.count_if(F.col("email").like("%@%")).alias("with_at"),
        F.count_if(F.col("last_name").contains("@")).alias("names_with_at"),
        F.count_if(F.col("phone").like("+91 %00")).alias("round_phones"))


@query("flt_08_in_having", with_tables("customers", """
SELECT customer_id, email FROM customers
WHERE email IN (SELECT email FROM customers GROUP BY email HAVING count(*) > 1)"""))
def _(spark, d):
    return rows_with_duplicated_key(customers(spark, d), "email", work_dir(spark)).select("customer_id", "email")


# --- joins ---------------------------------------------------------------------------------------


@query("jn_01_inner", with_tables("customers rides", f"""
SELECT c.city, r.ride_status, count(*) AS rides, {mean('r.fare')} AS avg_fare
FROM customers c JOIN rides r ON c.customer_id = r.customer_id GROUP BY c.city, r.ride_status"""))
def _(spark, d):
    return (rides(spark, d).join(customers(spark, d), "customer_id").groupBy("city", "ride_status")
            .agg(F.count("*").alias("rides"), exact_mean("fare").alias("avg_fare")))


@query("jn_02_left_outer", with_tables("drivers rides", """
SELECT d.driver_id, count(r.ride_id) AS no_show_rides FROM drivers d
LEFT JOIN (SELECT * FROM rides WHERE ride_status = 'no_show' AND fare = 0) r ON d.driver_id = r.driver_id
GROUP BY d.driver_id"""))
def _(spark, d):
    free = (rides(spark, d).filter((F.col("ride_status") == "no_show") & (F.col("fare") == 0))
            .groupBy("driver_id").agg(F.count("ride_id").alias("n")))
    return (drivers(spark, d).select("driver_id").join(free, "driver_id", "left")
            .select("driver_id", F.coalesce("n", F.lit(0)).alias("no_show_rides")))


@query("jn_03_semi", with_tables("rides payments", """
SELECT payment_id, ride_id FROM payments p WHERE EXISTS (SELECT 1 FROM rides r WHERE r.ride_id = p.ride_id)"""))
def _(spark, d):
    return (payments(spark, d).join(rides(spark, d).select("ride_id"), "ride_id", "left_semi")
            .select("payment_id", "ride_id"))


@query("jn_04_anti", with_tables("rides payments", """
SELECT payment_id, ride_id FROM payments p WHERE NOT EXISTS (SELECT 1 FROM rides r WHERE r.ride_id = p.ride_id)"""))
def _(spark, d):
    return (payments(spark, d).join(rides(spark, d).select("ride_id"), "ride_id", "left_anti")
            .select("payment_id", "ride_id"))


_NULLABLE_KEY = "CASE WHEN payment_status = 'refunded' THEN NULL ELSE ride_id END"


@query("jn_05_null_aware_anti", with_tables("rides payments", f"""
SELECT payment_id, {_NULLABLE_KEY} AS key FROM payments
WHERE {_NULLABLE_KEY} NOT IN (SELECT ride_id FROM rides)"""))
def _(spark, d):
    keyed = payments(spark, d).select("payment_id", F.expr(_NULLABLE_KEY).alias("key"))
    return reconcile.orphans(keyed, "key", rides(spark, d), "ride_id")


@query("jn_06_orphan_count", with_tables("rides payments", """
SELECT count(*) AS orphan_payments, count(DISTINCT p.ride_id) AS orphan_keys
FROM payments p LEFT JOIN rides r ON p.ride_id = r.ride_id WHERE r.ride_id IS NULL"""))
def _(spark, d):
    return reconcile.orphan_keys(payments(spark, d), "ride_id", rides(spark, d), "ride_id").agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("orphan_payments"), F.count("*").alias("orphan_keys"))


@query("jn_08_enrichment", with_tables("customers drivers rides", """
, places AS (SELECT DISTINCT pickup_city AS place_city, pickup_area AS place_area, lower(trim(pickup_city)) AS place
  FROM rides)
SELECT r.ride_id, r.fare, c.first_name AS segment, d.vehicle_type, d.rating, p.place
FROM rides r LEFT JOIN customers c ON r.customer_id = c.customer_id LEFT JOIN drivers d ON r.driver_id = d.driver_id
LEFT JOIN places p ON r.pickup_city = p.place_city AND r.pickup_area = p.place_area""".replace("\n, places", ",\nplaces", 1)))
def _(spark, d):
    t = tables(spark, d)
    places = (t["rides"].select(F.col("pickup_city").alias("place_city"), F.col("pickup_area").alias("place_area")).distinct()
              .withColumn("place", F.lower(F.trim("place_city"))))
    r = t["rides"]
    return (r.join(t["customers"].select("customer_id", F.col("first_name").alias("segment")), "customer_id", "left")
            .join(t["drivers"].select("driver_id", "vehicle_type", "rating"), "driver_id", "left")
            .join(places, (F.col("pickup_city") == F.col("place_city")) & (F.col("pickup_area") == F.col("place_area")), "left")
            .select("ride_id", "fare", "segment", "vehicle_type", "rating", "place"))


@query("jn_09_reconciliation", with_tables("rides payments", """
SELECT finding, count(*) AS keys, sum(fare)::DECIMAL(18,2) AS fare, sum(paid)::DECIMAL(18,2) AS paid FROM (
  SELECT coalesce(r.ride_id, p.ride_id) AS ride_id, r.fare, p.paid,
    CASE WHEN r.ride_id IS NULL THEN 'missing_ride' WHEN r.done AND p.ride_id IS NULL THEN 'missing_payment'
      WHEN r.done AND p.paid <> r.fare THEN 'amount_mismatch' ELSE 'ok' END AS finding
  FROM (SELECT ride_id, min(fare) AS fare, bool_or(ride_status = 'completed') AS done FROM rides GROUP BY ride_id) r
  FULL JOIN (SELECT ride_id, sum(amount) FILTER (payment_status = 'completed') AS paid FROM payments GROUP BY ride_id) p
  ON r.ride_id = p.ride_id) GROUP BY finding"""))
def _(spark, d):
    t = tables(spark, d)
    return (reconcile.reconcile_payments(t["rides"], t["payments"]).groupBy("finding")
            .agg(F.count("*").alias("keys"), total("fare").alias("fare"), total("paid").alias("paid")))


# --- aggregations --------------------------------------------------------------------------------


@query("ag_01_count_by", with_tables("rides", "SELECT ride_status, count(*) AS rides FROM rides GROUP BY ride_status"))
def _(spark, d):
    return rides(spark, d).groupBy("ride_status").agg(F.count("*").alias("rides"))


@query("ag_02_conditional_count", with_tables("payments", """
SELECT payment_method, count(CASE WHEN payment_status = 'failed' THEN 1 END) AS failed,
  count(CASE WHEN tip_amount > 0 THEN 1 END) AS tipped FROM payments GROUP BY payment_method"""))
def _(spark, d):
    return payments(spark, d).groupBy("payment_method").agg(
        F.count_if(F.col("payment_status") == "failed").alias("failed"),
        F.count_if(F.col("tip_amount") > 0).alias("tipped"))


@query("ag_03_sum_avg_min_max", with_tables("rides", f"""
SELECT ride_status, sum(fare)::DECIMAL(18,2) AS total_fare, {mean('fare')} AS avg_fare,
  min(distance_km) AS min_distance, max(distance_km) AS max_distance FROM rides GROUP BY ride_status"""))
def _(spark, d):
    return rides(spark, d).groupBy("ride_status").agg(
        total("fare").alias("total_fare"), exact_mean("fare").alias("avg_fare"),
        F.min("distance_km").alias("min_distance"), F.max("distance_km").alias("max_distance"))


@query("ag_04_group_by_two", with_tables("drivers", """
SELECT city, vehicle_type, count(*) AS drivers FROM drivers GROUP BY city, vehicle_type"""))
def _(spark, d):
    return drivers(spark, d).groupBy("city", "vehicle_type").agg(F.count("*").alias("drivers"))


@query("ag_05_group_by_expression", with_tables("rides", """
SELECT hour(request_time)::INT AS hour, date_trunc('month', request_time)::DATE AS month, count(*) AS rides
FROM rides GROUP BY 1, 2"""))
def _(spark, d):
    return (rides(spark, d)
            .groupBy(F.hour("request_time").alias("hour"), F.trunc(F.to_date("request_time"), "month").alias("month"))
            .agg(F.count("*").alias("rides")))


@query("ag_06_median", with_tables("rides", """
SELECT driver_id, round(quantile_cont(fare::DOUBLE, 0.5)::DECIMAL(18,4), 2)::DECIMAL(18,2) AS median_fare
FROM rides GROUP BY driver_id"""))
def _(spark, d):
    return median_by(rides(spark, d), ["driver_id"], "fare", "median_fare")


@query("ag_07_rate", with_tables("rides", f"""
SELECT dropoff_city, {percent("count(*) FILTER (ride_status = 'completed')", 'count(*)')} AS completed_pct
FROM rides GROUP BY dropoff_city"""))
def _(spark, d):
    return rides(spark, d).groupBy("dropoff_city").agg(
        exact_percent(F.count_if(F.col("ride_status") == "completed"), F.count("*")).alias("completed_pct"))


@query("ag_08_having", with_tables("rides", """
SELECT ride_id, count(*) AS copies FROM rides GROUP BY ride_id HAVING count(*) > 1"""))
def _(spark, d):
    return duplicated_keys(rides(spark, d), ["ride_id"])


@query("ag_09_count_non_null", with_tables("rides", """
SELECT pickup_area, count(*) AS rides, count(pickup_time) AS picked_up, count(dropoff_time) AS dropped_off
FROM rides GROUP BY pickup_area"""))
def _(spark, d):
    return rides(spark, d).groupBy("pickup_area").agg(
        F.count("*").alias("rides"), F.count("pickup_time").alias("picked_up"), F.count("dropoff_time").alias("dropped_off"))


@query("ag_10_uniqueness", with_tables("rides", """
SELECT count(*) AS row_count, count(DISTINCT ride_id) AS distinct_keys FROM rides"""))
def _(spark, d):
    return uniqueness(rides(spark, d), "ride_id")


# Stored sketches of the days answer for all days; the error is judged against the exact count.
@query("ag_10_stored_sketches", with_tables("rides", """
SELECT n AS row_count, true AS rides_within_5_percent, true AS customers_within_5_percent FROM (SELECT count(*) AS n FROM rides)"""))
def _(spark, d):
    r = rides(spark, d).withColumn("day", F.to_date("request_time"))
    found = []
    for key in ("ride_id", "customer_id"):
        stored = materialize(key_sketches(r, key, ["day"]), work_dir(spark))
        found.append(uniqueness_of(stored).join(uniqueness(r, key).select(F.col("row_count").alias("n"), "distinct_keys"), F.col("row_count") == F.col("n"))
                     .select("row_count", (F.abs(F.col("about_distinct_keys") - F.col("distinct_keys")) <= 0.05 * F.col("distinct_keys")).alias(f"{key}_near")))
    return found[0].join(found[1], "row_count").select("row_count", F.col("ride_id_near").alias("rides_within_5_percent"),
                                                       F.col("customer_id_near").alias("customers_within_5_percent"))


@query("ag_11_global", with_tables("rides", f"""
SELECT count(*) AS rides, {mean('fare')} AS avg_fare, count(*) FILTER (fare = 0) AS free_rides FROM rides"""))
def _(spark, d):
    return rides(spark, d).agg(F.count("*").alias("rides"), exact_mean("fare").alias("avg_fare"),
                               F.count_if(F.col("fare") == 0).alias("free_rides"))


# --- windows -------------------------------------------------------------------------------------


@query("wn_01_share_of_total", with_tables("rides", f"""
SELECT ride_status, count(*) AS rides, {percent('count(*)', '(sum(count(*)) OVER ())::HUGEINT')} AS pct
FROM rides GROUP BY ride_status"""))
def _(spark, d):
    return share_of_total(rides(spark, d).groupBy("ride_status").agg(F.count("*").alias("rides")), "rides", "pct")


@query("wn_02_first_per_key", with_tables("customers", """
SELECT DISTINCT ON (email) customer_id, email, first_name, city FROM customers ORDER BY email, customer_id"""))
def _(spark, d):
    return first_per_key(customers(spark, d), ["email"], ["customer_id"]).select("customer_id", "email", "first_name", "city")


_DAILY = """daily AS (
  SELECT day::DATE AS day, count(ride_id) AS rides
  FROM (SELECT unnest(generate_series(min(request_time)::DATE, max(request_time)::DATE, INTERVAL 1 DAY)) AS day FROM rides)
  LEFT JOIN rides ON request_time::DATE = day::DATE GROUP BY 1)"""

_ROLLING = """
SELECT day, rides, ((2 * 100 * s + n) // nullif(2 * n, 0) * 0.01)::DECIMAL(18,2) AS rolling_avg FROM (
  SELECT day, rides, (sum(rides) OVER w)::HUGEINT AS s, count(*) OVER w AS n FROM daily
  WINDOW w AS (ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))"""


@query("wn_03_rolling_mean", with_tables("rides", _ROLLING, _DAILY))
def _(spark, d):
    return rolling_mean(daily_counts(rides(spark, d), "request_time"), "day", "rides")


@query("wn_05_growth", with_tables("rides", """
SELECT month, total_rides, round(100.0 * (total_rides - p) / p, 1)::DECIMAL(18,1) AS growth_pct FROM (
  SELECT month, total_rides, lag(total_rides) OVER (ORDER BY month) AS p FROM (
    SELECT date_trunc('month', request_time)::DATE AS month, count(*) AS total_rides FROM rides GROUP BY 1))"""))
def _(spark, d):
    return kpis.monthly_growth({"rides": rides(spark, d)})


@query("wn_06_rank", with_tables("rides", """
SELECT pickup_area, driver_id, rides, rank() OVER (PARTITION BY pickup_area ORDER BY rides DESC) AS place,
  dense_rank() OVER (PARTITION BY pickup_area ORDER BY rides DESC) AS dense_place
FROM (SELECT pickup_area, driver_id, count(*) AS rides FROM rides GROUP BY pickup_area, driver_id)"""))
def _(spark, d):
    per_driver = rides(spark, d).groupBy("pickup_area", "driver_id").agg(F.count("*").alias("rides"))
    return ranked(ranked(per_driver, "rides", ["pickup_area"], "place"), "rides", ["pickup_area"], "dense_place", dense=True)


# --- sorts and limits ----------------------------------------------------------------------------


@query("so_01_order_desc", with_tables("rides", """
SELECT pickup_area, count(*) AS rides FROM rides GROUP BY pickup_area ORDER BY rides DESC, pickup_area"""))
def _(spark, d):
    return (rides(spark, d).groupBy("pickup_area").agg(F.count("*").alias("rides"))
            .orderBy(F.desc_nulls_first("rides"), "pickup_area"))


@query("so_02_order_asc", with_tables("rides", """
SELECT request_time::DATE AS day, count(*) AS rides FROM rides GROUP BY 1 ORDER BY 1"""))
def _(spark, d):
    return rides(spark, d).groupBy(F.to_date("request_time").alias("day")).agg(F.count("*").alias("rides")).orderBy("day")


@query("so_03_top_10", with_tables("payments", """
SELECT payment_id, amount FROM payments ORDER BY amount DESC, payment_id LIMIT 10"""))
def _(spark, d):
    return payments(spark, d).select("payment_id", "amount").orderBy(F.desc("amount"), "payment_id").limit(10)


# --- set operations ------------------------------------------------------------------------------


@query("se_01_union_all", with_tables("rides payments", """
SELECT 'ride' AS kind, ride_status AS status, count(*) AS n FROM rides GROUP BY 2
UNION ALL SELECT 'payment', payment_status, count(*) FROM payments GROUP BY 2"""))
def _(spark, d):
    def counts(df, kind, column):
        return df.groupBy(F.col(column).alias("status")).agg(F.count("*").alias("n")).withColumn("kind", F.lit(kind))
    return counts(rides(spark, d), "ride", "ride_status").unionByName(counts(payments(spark, d), "payment", "payment_status"))


@query("se_02_distinct", with_tables("rides", "SELECT DISTINCT pickup_city, dropoff_city FROM rides"))
def _(spark, d):
    return rides(spark, d).select("pickup_city", "dropoff_city").distinct()


@query("se_03_difference", with_tables("customers rides", """
SELECT customer_id, 'without_ride' AS state FROM (SELECT customer_id FROM customers EXCEPT SELECT customer_id FROM rides)
UNION ALL SELECT customer_id, 'with_ride' FROM (SELECT customer_id FROM customers INTERSECT SELECT customer_id FROM rides)"""))
def _(spark, d):
    ids, used = customers(spark, d).select("customer_id"), rides(spark, d).select("customer_id")
    return (ids.subtract(used).withColumn("state", F.lit("without_ride"))
            .unionByName(ids.intersect(used).withColumn("state", F.lit("with_ride"))))


@query("src_05_parquet_scan", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 100000")
def _(spark, d):
    return load(spark, d, "orders").filter("o_totalprice > 100000").select("o_orderkey", "o_totalprice")
