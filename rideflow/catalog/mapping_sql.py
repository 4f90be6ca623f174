"""The ride-hailing datasets as common table expressions for the oracle engine."""

from __future__ import annotations


def _city(key):
    return f"['Mumbai','Pune','Bangalore','Delhi','Hyderabad','Chennai'][({key} % 6) + 1]"


def _id(prefix, key, width):
    return f"'{prefix}' || lpad({key}::VARCHAR, greatest({width}, length({key}::VARCHAR))::INT, '0')"


CUSTOMERS = f"""customers AS (
  SELECT {_id('C', 'c_custkey', 7)} AS customer_id, c_mktsegment AS first_name, substr(c_name, 10) AS last_name,
    'u' || (c_custkey - CASE WHEN c_custkey % 100 = 99 THEN 1 ELSE 0 END) || '@example.com' AS email,
    '+91 ' || lpad((c_custkey * 7919 % 10000000000)::VARCHAR, 10, '0') AS phone,
    {_city('c_nationkey')} AS city, DATE '1994-01-01' + (c_custkey % 365)::INT AS signup_date,
    CASE WHEN c_acctbal < 0 THEN 'False' ELSE 'True' END AS is_active
  FROM customer)"""

DRIVERS = f"""drivers AS (
  SELECT {_id('D', 's_suppkey', 5)} AS driver_id, substr(s_name, 1, 8) AS first_name, substr(s_name, 10) AS last_name,
    '+91 ' || lpad((s_suppkey * 104729 % 10000000000)::VARCHAR, 10, '0') AS phone, {_city('s_nationkey')} AS city,
    ['Sedan','Hatchback','SUV','Auto','Bike'][(s_suppkey % 5) + 1] AS vehicle_type,
    'MH-' || lpad((s_suppkey - CASE WHEN s_suppkey % 50 = 49 THEN 1 ELSE 0 END)::VARCHAR, 10, '0') AS license_number,
    (1.0 + (s_suppkey % 41) * 0.1)::DECIMAL(3,1) AS rating, DATE '1993-01-01' + (s_suppkey % 730)::INT AS join_date,
    CASE WHEN s_acctbal < 0 THEN 'False' ELSE 'True' END AS is_active
  FROM supplier)"""

RIDES = f"""ride_base AS (
  SELECT *, {_city('l_suppkey')} AS clean_city,
    CASE WHEN l_returnflag = 'A' THEN 'completed' WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 'completed'
      WHEN l_returnflag = 'N' THEN 'ongoing' WHEN l_linestatus = 'F' THEN 'cancelled' ELSE 'no_show' END AS status,
    o_orderdate + to_seconds(l_partkey * 37 % 86400) AS requested
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
rides AS (
  SELECT 'R' || l_orderkey || '-' || l_linenumber AS ride_id, {_id('C', 'o_custkey', 7)} AS customer_id,
    {_id('D', 'l_suppkey', 5)} AS driver_id,
    CASE l_partkey % 33 WHEN 0 THEN lower(clean_city) WHEN 1 THEN upper(clean_city) WHEN 2 THEN clean_city || ' '
      WHEN 3 THEN replace(replace(clean_city, 'Bangalore', 'Bengaluru'), 'Delhi', 'New Delhi')
      ELSE clean_city END AS pickup_city,
    'Area ' || (l_partkey % 10) AS pickup_area, {_city('o_custkey')} AS dropoff_city,
    'Area ' || (o_custkey % 10) AS dropoff_area,
    CASE WHEN l_partkey % 211 = 7 THEN 190.0::DECIMAL(10,6)
      ELSE (18.9 + (l_orderkey % 350) * 0.001)::DECIMAL(10,6) END AS pickup_lat,
    (72.77 + (l_suppkey % 200) * 0.001)::DECIMAL(10,6) AS pickup_lon,
    (18.9 + (o_custkey % 350) * 0.001)::DECIMAL(10,6) AS dropoff_lat,
    (72.77 + (l_partkey % 200) * 0.001)::DECIMAL(10,6) AS dropoff_lon,
    requested AS request_time,
    CASE WHEN status IN ('completed', 'ongoing') OR (status = 'cancelled' AND l_partkey % 2 = 0)
      THEN requested + to_minutes((l_partkey % 14 + 2)::BIGINT) END AS pickup_time,
    CASE WHEN status = 'completed' THEN requested + to_minutes(
      CASE WHEN l_partkey % 97 = 5 THEN 1 ELSE (l_partkey % 14 + 7 + l_quantity)::BIGINT END) END AS dropoff_time,
    (CASE WHEN l_partkey % 50 = 0 THEN -l_quantity ELSE l_quantity END)::DECIMAL(12,2) AS distance_km,
    (CASE WHEN l_partkey % 100 = 1 THEN 0 ELSE l_extendedprice END)::DECIMAL(12,2) AS fare,
    (1.0 + l_discount::DECIMAL(4,2) * 15)::DECIMAL(4,2) AS surge_multiplier, status AS ride_status
  FROM ride_base)"""

PAYMENTS = f"""payments AS (
  SELECT 'P' || o_orderkey AS payment_id, 'R' || o_orderkey || '-1' AS ride_id,
    {_id('C', 'o_custkey', 7)} AS customer_id,
    (CASE WHEN o_orderkey % 101 = 0 THEN -1 ELSE o_totalprice END)::DECIMAL(12,2) AS amount,
    ['UPI','Credit Card','Debit Card','Cash','Wallet'][substr(o_orderpriority, 1, 1)::INT] AS payment_method,
    CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending'
      ELSE CASE WHEN o_orderkey % 4 = 0 THEN 'refunded' ELSE 'failed' END END AS payment_status,
    o_orderdate AS payment_time,
    (CASE WHEN o_orderkey % 5 = 0 THEN o_orderkey % 91 + 10 ELSE 0 END)::DECIMAL(12,2) AS tip_amount
  FROM orders)"""

_BASE = {"customers": CUSTOMERS, "drivers": DRIVERS, "rides": RIDES, "payments": PAYMENTS}


def with_tables(names: str, body: str, *ctes: str) -> str:
    """WITH clause of the datasets in `names` (blank separated), further `ctes`, then `body`."""
    parts = [_BASE[n] for n in names.split()] + list(ctes)
    return "WITH " + ",\n".join(parts) + "\n" + body


def mean(expr: str, scale: int = 2) -> str:
    """Exact average rounded half away from zero."""
    return quotient(f"sum({expr})", f"count({expr})", scale)


def quotient(total: str, count: str, scale: int = 2) -> str:
    """total / count in whole numbers: total has at most `scale` decimals."""
    unit = 10 ** scale
    return (f"(sign({total}) * CAST((2 * CAST(abs({total}) * {unit} AS HUGEINT) + ({count})) "
            f"// nullif(2 * ({count}), 0) AS DECIMAL(18,0)) * {1 / unit:.{scale}f})::DECIMAL(18,{scale})")


def percent(part: str, whole: str, scale: int = 1) -> str:
    unit = 10 ** scale
    return (f"(CAST((2 * CAST({part} AS HUGEINT) * {100 * unit} + ({whole})) // nullif(2 * ({whole}), 0) "
            f"AS DECIMAL(18,0)) * {1 / unit:.{scale}f})::DECIMAL(18,{scale})")


CLEAN_CITY = ("CASE lower(trim({c})) WHEN 'bengaluru' THEN 'Bangalore' WHEN 'new delhi' THEN 'Delhi' "
              "ELSE upper(substr(trim({c}), 1, 1)) || lower(substr(trim({c}), 2)) END")


def clean_city(column: str) -> str:
    return CLEAN_CITY.format(c=column)
