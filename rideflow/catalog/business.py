"""Business queries, dashboard views and KPIs."""

from __future__ import annotations

from rideflow.catalog.mapping_sql import mean, percent, quotient, with_tables
from rideflow.catalog.registry import query
from rideflow.plans import business, views
from rideflow.sources.testdata import tables


def _plan(name, fn, sql):
    query(name, sql)(lambda spark, sf_dir: fn(tables(spark, sf_dir)))


_plan("q01_rides_per_city", business.q01, with_tables("rides", """
SELECT pickup_city, count(*) AS total_rides, count(*) FILTER (ride_status = 'completed') AS completed,
  count(*) FILTER (ride_status = 'cancelled') AS cancelled
FROM rides GROUP BY pickup_city"""))

_plan("q02_fare_by_status", business.q02, with_tables("rides", f"""
SELECT ride_status, count(*) AS ride_count, {mean('fare')} AS avg_fare,
  min(fare)::DECIMAL(18,2) AS min_fare, max(fare)::DECIMAL(18,2) AS max_fare
FROM rides GROUP BY ride_status"""))

_plan("q03_peak_hours", business.q03, with_tables("rides", f"""
SELECT hour(request_time)::INT AS hour_of_day, count(*) AS total_rides, {mean('fare')} AS avg_fare,
  {mean('surge_multiplier')} AS avg_surge
FROM rides GROUP BY hour(request_time)"""))

_plan("q04_revenue_by_method", business.q04, with_tables("payments", f"""
SELECT payment_method, count(*) AS total_txns, sum(amount)::DECIMAL(18,2) AS total_revenue,
  {mean('amount')} AS avg_amount, sum(tip_amount)::DECIMAL(18,2) AS total_tips,
  {percent('count(*)', '(sum(count(*)) OVER ())::HUGEINT')} AS pct_of_total
FROM payments WHERE payment_status = 'completed' GROUP BY payment_method"""))

_plan("q05_top_drivers", business.q05, with_tables("drivers rides", """
SELECT driver_id, first_name || ' ' || last_name AS driver_name, vehicle_type, city, rating, completed_rides, total_earnings
FROM earned JOIN drivers USING (driver_id) ORDER BY completed_rides DESC, driver_id LIMIT 10""",
  """earned AS (SELECT driver_id, count(ride_id) AS completed_rides, sum(fare)::DECIMAL(18,2) AS total_earnings
  FROM rides WHERE ride_status = 'completed' GROUP BY driver_id)"""))

_plan("q06_cancellation_rate", business.q06, with_tables("rides", f"""
SELECT pickup_city, count(*) AS total_rides, count(*) FILTER (ride_status = 'cancelled') AS cancellations,
  {percent("count(*) FILTER (ride_status = 'cancelled')", 'count(*)')} AS cancellation_rate_pct
FROM rides GROUP BY pickup_city"""))

_plan("q07_monthly_trend", business.q07, with_tables("rides", """
SELECT date_trunc('month', request_time)::DATE AS month, count(*) AS total_rides,
  count(*) FILTER (ride_status = 'completed') AS completed, sum(fare)::DECIMAL(18,2) AS total_revenue
FROM rides GROUP BY 1"""))

_plan("q08_distance_stats", business.q08, with_tables("rides", f"""
SELECT pickup_city, count(*) AS completed_rides, {mean('distance_km')} AS avg_distance_km,
  min(distance_km)::DECIMAL(18,2) AS min_distance_km, max(distance_km)::DECIMAL(18,2) AS max_distance_km,
  round(quantile_cont(distance_km::DOUBLE, 0.5)::DECIMAL(18,4), 2)::DECIMAL(18,2) AS median_distance_km
FROM rides WHERE ride_status = 'completed' AND distance_km > 0 GROUP BY pickup_city"""))

_plan("q09_top_customers", business.q09, with_tables("customers rides", """
SELECT customer_id, first_name || ' ' || last_name AS customer_name, city, is_active, total_rides, completed_rides, total_spent
FROM spent JOIN customers USING (customer_id) ORDER BY total_rides DESC, customer_id LIMIT 10""",
  """spent AS (SELECT customer_id, count(ride_id) AS total_rides, count_if(ride_status = 'completed')::BIGINT AS completed_rides,
  sum(fare)::DECIMAL(18,2) AS total_spent FROM rides GROUP BY customer_id)"""))

_plan("q10_payment_success", business.q10, with_tables("payments", f"""
SELECT payment_method, sum(n)::BIGINT AS total_txns, sum(n * (state = 'completed')::INT)::BIGINT AS successful,
  sum(n * (state = 'failed')::INT)::BIGINT AS failed, sum(n * (state = 'refunded')::INT)::BIGINT AS refunded,
  sum(n * (state = 'pending')::INT)::BIGINT AS pending,
  {percent("sum(n * (state = 'completed')::INT)", 'sum(n)')} AS success_rate_pct
FROM per_state GROUP BY payment_method""",
  """per_state AS (SELECT payment_method, coalesce(payment_status, '') AS state, count(*) AS n FROM payments GROUP BY ALL)"""))

_plan("bv_01_rides_by_city", views.v_rides_by_city, with_tables("rides", f"""
SELECT pickup_city, ride_status, count(*) AS total_rides, {mean('fare')} AS avg_fare,
  {mean('distance_km')} AS avg_distance, {mean('surge_multiplier')} AS avg_surge
FROM rides GROUP BY pickup_city, ride_status"""))

_plan("bv_02_revenue_by_method", views.v_revenue_by_method, with_tables("payments", f"""
SELECT payment_method, payment_status, count(*) AS total_payments, sum(amount)::DECIMAL(18,2) AS total_revenue,
  {mean('amount')} AS avg_payment, sum(tip_amount)::DECIMAL(18,2) AS total_tips
FROM payments GROUP BY payment_method, payment_status"""))

_plan("bv_03_driver_performance", views.v_driver_performance, with_tables("drivers rides", f"""
SELECT vehicle_type, city, coalesce(sum(n), 0)::BIGINT AS total_rides, {quotient('sum(fares)', 'sum(n_fares)')} AS avg_fare,
  {quotient('sum(kms)', 'sum(n_kms)')} AS avg_distance
FROM drivers LEFT JOIN driven USING (driver_id) GROUP BY vehicle_type, city""",
  """driven AS (SELECT driver_id, count(ride_id) AS n, sum(fare) AS fares, count(fare) AS n_fares, sum(distance_km) AS kms,
  count(distance_km) AS n_kms FROM rides GROUP BY driver_id)"""))

_plan("bv_04_hourly_demand", views.v_hourly_demand, with_tables("rides", f"""
SELECT hour(request_time)::INT AS hour_of_day, pickup_city, count(*) AS total_rides, {mean('fare')} AS avg_fare
FROM rides GROUP BY 1, 2"""))
