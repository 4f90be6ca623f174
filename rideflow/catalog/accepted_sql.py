"""Oracle text for accepted rows, failure reasons, Silver and Gold."""

from __future__ import annotations

from rideflow.catalog.mapping_sql import clean_city, with_tables

RIDE_COLUMNS = ("ride_id customer_id driver_id pickup_city pickup_area dropoff_city dropoff_area pickup_lat pickup_lon "
                "dropoff_lat dropoff_lon request_time pickup_time dropoff_time distance_km fare surge_multiplier "
                "ride_status").split()
RIDE_ORDER = ", ".join(f"{c} NULLS FIRST" for c in RIDE_COLUMNS[1:])

# --- the load profile ----------------------------------------------------------------------------

# What a row must fulfil by itself, as the rule tables of the specification state it.
DRIVER_LIMITS = """driver_id IS NOT NULL
  AND rating >= 1.0 AND rating <= 5.0
  AND vehicle_type IN ('Sedan', 'Hatchback', 'SUV', 'Auto', 'Bike')"""
RIDE_LIMITS = """ride_id IS NOT NULL
  AND distance_km >= 0
  AND fare >= 0
  AND surge_multiplier >= 1.0
  AND ride_status IN ('completed', 'cancelled', 'ongoing', 'no_show')"""
PAYMENT_LIMITS = """payment_id IS NOT NULL
  AND amount >= 0
  AND tip_amount >= 0
  AND payment_method IN ('UPI', 'Credit Card', 'Debit Card', 'Cash', 'Wallet')
  AND payment_status IN ('completed', 'pending', 'failed', 'refunded')"""

CUSTOMERS_OK = """customers_ok AS (
  SELECT * FROM customers WHERE customer_id IS NOT NULL AND email IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY email ORDER BY customer_id) = 1)"""

DRIVERS_OK = f"""drivers_ok AS (
  SELECT * FROM drivers WHERE {DRIVER_LIMITS}
  QUALIFY row_number() OVER (PARTITION BY license_number ORDER BY driver_id) = 1)"""

RIDES_PASSED = f"""rides_passed AS (
  SELECT rides.* FROM rides SEMI JOIN customers_ok USING (customer_id) SEMI JOIN drivers_ok USING (driver_id) WHERE {RIDE_LIMITS})"""

RIDES_OK = f"""rides_ok AS (
  SELECT * FROM rides_passed QUALIFY row_number() OVER (PARTITION BY ride_id ORDER BY {RIDE_ORDER}) = 1)"""

PAYMENTS_OK = f"""payments_ok AS (
  SELECT payments.* FROM payments SEMI JOIN customers_ok USING (customer_id) SEMI JOIN rides_passed USING (ride_id) WHERE {PAYMENT_LIMITS})"""

ACCEPTED = (CUSTOMERS_OK, DRIVERS_OK, RIDES_PASSED, RIDES_OK, PAYMENTS_OK)

# Failure reasons per row, for rows that fail something other than uniqueness; then the losers.
RIDE_REASONS = f"""ride_reasons AS (
  SELECT 'NEGATIVE_DISTANCE' AS reason, count(*) AS n FROM rides WHERE distance_km < 0
  UNION ALL SELECT 'INVALID_SURGE', count(*) FROM rides WHERE surge_multiplier < 1.0
  UNION ALL SELECT 'ZERO_FARE', count(*) FROM rides WHERE fare = 0 AND ride_status = 'completed'
  UNION ALL SELECT 'ORPHAN_CUSTOMER', count(*) FROM rides WHERE customer_id NOT IN (SELECT customer_id FROM customers_ok)
  UNION ALL SELECT 'ORPHAN_DRIVER', count(*) FROM rides WHERE driver_id NOT IN (SELECT driver_id FROM drivers_ok)
  UNION ALL SELECT 'DUPLICATE_PK', (SELECT count(*) FROM rides_passed) - (SELECT count(*) FROM rides_ok))"""

PAYMENT_REASONS = """payment_reasons AS (
  SELECT 'NEGATIVE_AMOUNT' AS reason, count(*) AS n FROM payments WHERE amount < 0
  UNION ALL SELECT 'NEGATIVE_TIP', count(*) FROM payments WHERE tip_amount < 0
  UNION ALL SELECT 'ORPHAN_RIDE', count(*) FROM payments WHERE ride_id NOT IN (SELECT ride_id FROM rides_passed)
  UNION ALL SELECT 'ORPHAN_PAYMENT_CUSTOMER', count(*) FROM payments
    WHERE customer_id NOT IN (SELECT customer_id FROM customers_ok))"""

REASONS = """reasons AS (
  SELECT 'customers' AS table_name, 'DUPLICATE_EMAIL' AS reason,
    (SELECT count(*) FROM customers) - (SELECT count(*) FROM customers_ok) AS rows
  UNION ALL SELECT 'drivers', 'INVALID_RATING', (SELECT count(*) FROM drivers WHERE rating < 1.0 OR rating > 5.0)
  UNION ALL SELECT 'drivers', 'DUPLICATE_LICENSE',
    (SELECT count(*) FROM drivers WHERE rating BETWEEN 1.0 AND 5.0) - (SELECT count(*) FROM drivers_ok)
  UNION ALL SELECT 'rides', reason, n FROM ride_reasons
  UNION ALL SELECT 'payments', reason, n FROM payment_reasons)"""


def accepted(body: str, *ctes: str) -> str:
    return with_tables("customers drivers rides payments", body, *ACCEPTED, *ctes)


# --- Silver and Gold -----------------------------------------------------------------------------

_SILVER_RIDE = f"""SELECT * REPLACE ({clean_city('pickup_city')} AS pickup_city, {clean_city('dropoff_city')} AS dropoff_city)
  FROM rides"""

SILVER = (
    CUSTOMERS_OK.replace("customers_ok AS", "silver_customers AS"),
    DRIVERS_OK.replace("drivers_ok AS", "silver_drivers AS"),
    f"""silver_rides AS (
  SELECT * FROM ({_SILVER_RIDE}) r WHERE {RIDE_LIMITS} AND fare > 0
    AND pickup_lat BETWEEN -90 AND 90 AND dropoff_lat BETWEEN -90 AND 90
    AND (ride_status <> 'completed' OR (pickup_time IS NOT NULL AND dropoff_time IS NOT NULL))
    AND coalesce(pickup_time >= request_time, true) AND coalesce(dropoff_time >= pickup_time, true)
    AND EXISTS (SELECT 1 FROM silver_customers c WHERE c.customer_id = r.customer_id)
    AND EXISTS (SELECT 1 FROM silver_drivers d WHERE d.driver_id = r.driver_id)
  QUALIFY row_number() OVER (PARTITION BY ride_id ORDER BY {RIDE_ORDER}) = 1)""",
    PAYMENTS_OK.replace("payments_ok AS", "silver_payments AS").replace("rides_passed", "silver_rides")
    .replace("customers_ok", "silver_customers"),
)


def silver(body: str, *ctes: str) -> str:
    return with_tables("customers drivers rides payments", body, *SILVER, *ctes)


def key(*parts: str) -> str:
    if len(parts) > 1:
        parts = tuple(f"replace(replace({p}, '\\', '\\\\'), '|', '\\|')" for p in parts)
    joined = " || '|' || ".join(parts)
    return f"('0x' || substr(md5({joined}), 1, 15))::BIGINT"
