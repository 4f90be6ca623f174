"""Sources, sinks, Silver steps, the star schema, and the queries over them."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import functions as F

from rideflow import schemas
from rideflow.catalog import stores
from rideflow.catalog.accepted_sql import accepted, key, silver
from rideflow.catalog.mapping_sql import clean_city, mean, percent, quotient, with_tables
from rideflow.catalog.registry import query
from rideflow.catalog.scalar import _geohash_sql
from rideflow.operators import gold, history, privacy, quality
from rideflow.operators import silver as steps
from rideflow.operators.dedupe import first_per_key, mark_first
from rideflow.plans import kpis, lake, load
from rideflow.sources import bucketed, ledger, maintenance, merge, readers, sinks
from rideflow.sources.testdata import as_text, customers, drivers, payments, rides, tables
from rideflow.sources.workdir import materialize, work_dir

SALT = stores.SALT


def _union(frames):
    result = None
    for f in frames:
        result = f if result is None else result.unionByName(f)
    return result


# --- sources and sinks ---------------------------------------------------------------------------

_CUSTOMER_COLUMNS = "customer_id, first_name, last_name, email, phone, city, signup_date, is_active"


@query("src_01_csv_scan", with_tables("customers", f"SELECT {_CUSTOMER_COLUMNS} FROM customers"))
def _(spark, d):
    path = work_dir(spark)
    sinks.write_csv(customers(spark, d), path)
    return readers.read_raw(spark, path, schemas.CUSTOMERS)


@query("src_02_lenient_scan", with_tables("payments", """
SELECT payment_id, CASE WHEN payment_method = 'Cash' THEN NULL ELSE amount::DECIMAL(10,2) END AS amount,
  payment_time, CASE WHEN payment_method = 'Cash' THEN 1 ELSE 0 END AS malformed FROM payments"""))
def _(spark, d):
    path = work_dir(spark)
    dirty = as_text(payments(spark, d)).withColumn(
        "amount", F.when(F.col("payment_method") == "Cash", F.concat(F.lit("Rs "), "amount")).otherwise(F.col("amount")))
    sinks.write_csv(dirty, path)
    typed = steps.conform(readers.read_raw(spark, path, schemas.PAYMENTS, lenient=True), schemas.PAYMENTS)
    return typed.select("payment_id", "amount", "payment_time", F.size("failures").alias("malformed"))


@query("src_03_json_scan", with_tables("drivers", """
SELECT driver_id, first_name, last_name, phone, city, vehicle_type, license_number, rating, join_date, is_active FROM drivers"""))
def _(spark, d):
    path = work_dir(spark)
    sinks.write_json(drivers(spark, d), path)
    return readers.read_json(spark, path, schemas.DRIVERS, array=False)


@contextmanager
def _small_splits(spark, size="65536"):
    """Files are read in splits of `size` bytes, as a large file would be."""
    limit = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(limit)
    spark.conf.set(limit, size)
    try:
        yield
    finally:
        spark.conf.set(limit, before)


# One file read in splits of 64 kB; two columns hold line breaks, quotes and separators.
@query("src_01_csv_line_breaks", with_tables("customers", """
SELECT customer_id, first_name || chr(10) || '"' || chr(13) || chr(10) || ',' AS first_name, last_name, email,
  CASE WHEN substr(customer_id, 2)::BIGINT % 3 = 0 THEN chr(10) || chr(10) || city ELSE city END AS city, signup_date FROM customers"""))
def _(spark, d):
    path = work_dir(spark)
    third = F.substring("customer_id", 2, 20).cast("bigint") % 3 == 0
    odd = customers(spark, d).withColumns({"first_name": F.concat("first_name", F.lit('\n"\r\n,')),
                                           "city": F.when(third, F.concat(F.lit("\n\n"), "city")).otherwise(F.col("city"))})
    sinks.write_csv(odd.coalesce(1), path, line_breaks=True)
    with _small_splits(spark):
        found = materialize(readers.read_csv_splits(spark, path, schemas.CUSTOMERS), work_dir(spark))
    return found.select("customer_id", "first_name", "last_name", "email", "city", "signup_date")


# Arrays as they are written are read in splits.
@query("snk_02_json_arrays", with_tables("payments", """
SELECT payment_id, ride_id, customer_id, amount, payment_method, payment_status, payment_time, tip_amount FROM payments"""))
def _(spark, d):
    path = work_dir(spark)
    sinks.write_json_arrays(payments(spark, d), path)
    with _small_splits(spark):
        return materialize(readers.read_json_splits(spark, path, schemas.PAYMENTS), work_dir(spark))


# One array in one file, read in splits of 64 kB; names hold braces, quotes and escapes.
@query("src_03_json_array_splits", with_tables("customers", """
SELECT customer_id, first_name || '}"{\\,[' AS first_name, last_name, email, city, signup_date FROM customers"""))
def _(spark, d):
    path = work_dir(spark)
    odd = customers(spark, d).withColumn("first_name", F.concat("first_name", F.lit('}"{\\,[')))
    lines = odd.select(F.to_json(F.struct(*odd.columns)).alias("value")).coalesce(1)
    lines = lines.select(F.concat(F.when(F.monotonically_increasing_id() == 0, "").otherwise(","), "value").alias("value"))
    bracket = spark.range(1, numPartitions=1)
    array = bracket.select(F.lit("[").alias("value")).unionByName(lines).unionByName(bracket.select(F.lit("]").alias("value")))
    array.coalesce(1).write.text(path)
    with _small_splits(spark):
        found = materialize(readers.read_json_splits(spark, path, schemas.CUSTOMERS), work_dir(spark))
    return found.select("customer_id", "first_name", "last_name", "email", "city", "signup_date")


@query("snk_01_csv_roundtrip", with_tables("rides", """
SELECT ride_id, pickup_city, request_time, pickup_time, dropoff_time, distance_km, fare, surge_multiplier FROM rides"""))
def _(spark, d):
    path = work_dir(spark)
    sinks.write_csv(rides(spark, d), path)
    return readers.read_raw(spark, path, schemas.RIDES).select(
        "ride_id", "pickup_city", "request_time", "pickup_time", "dropoff_time", "distance_km", "fare", "surge_multiplier")


@query("snk_02_json_roundtrip", with_tables("payments", """
SELECT payment_id, ride_id, customer_id, amount, payment_method, payment_status, payment_time, tip_amount FROM payments"""))
def _(spark, d):
    path = work_dir(spark)
    sinks.write_json(payments(spark, d), path)
    return readers.read_json(spark, path, schemas.PAYMENTS, array=False)


def _land_by_month(spark, d):
    """Payments landed under the first day of their month, one directory per month."""
    root = work_dir(spark)
    month = F.trunc(F.to_date("payment_time"), "month")
    dated = (as_text(payments(spark, d))
             .withColumn("year", F.date_format(month, "yyyy")).withColumn("month", F.date_format(month, "MM"))
             .withColumn("day", F.lit("01")))
    (dated.hint("rebalance", "year", "month").write.mode("overwrite").option("header", True)
     .partitionBy("year", "month", "day").csv(f"{root}/bronze/payments"))
    return root


@query("src_04_partition_scan", with_tables("payments", """
SELECT payment_id, amount::VARCHAR AS amount, strftime(payment_time, '%Y') AS year, strftime(payment_time, '%m') AS month, '01' AS day
FROM payments WHERE payment_time >= TIMESTAMP '1996-06-01' AND payment_time < TIMESTAMP '1996-09-01'"""))
def _(spark, d):
    root = _land_by_month(spark, d)
    rows = readers.read_bronze(spark, root, "payments", schemas.PAYMENTS, ("1996-06-01", "1996-08-31"))
    return rows.select("payment_id", "amount", "year", "month", "day")


@query("flt_07_partition_predicate", with_tables("payments", """
SELECT strftime(payment_time, '%m') AS month, count(*) AS payments FROM payments WHERE year(payment_time) = 1997 GROUP BY 1"""))
def _(spark, d):
    root = _land_by_month(spark, d)
    return (readers.read_bronze(spark, root, "payments", schemas.PAYMENTS).filter("year = '1997'")
            .groupBy("month").agg(F.count("*").alias("payments")))


@query("snk_03_bronze_landing", with_tables("customers", """
SELECT count(*) AS source_rows, count(*) AS landed_rows, true AS identical, '2026-10-08' AS landed FROM customers"""))
def _(spark, d):
    root = work_dir(spark)
    raw = as_text(customers(spark, d))
    for _run in range(2):  # landing again replaces
        sinks.land_bronze(raw, root, "customers", "2026-10-08")
    landed = readers.read_bronze(spark, root, "customers", schemas.CUSTOMERS, ("2026-10-08", "2026-10-08"))
    return maintenance.verify_rows(raw, landed).withColumn("landed", F.lit("2026-10-08"))


@query("snk_04_backfill", with_tables("customers", """
SELECT '2026-10-07' AS landed, count(*) AS rows FROM customers UNION ALL SELECT '2026-10-08', count(*) FROM customers"""))
def _(spark, d):
    root = work_dir(spark)
    raw = as_text(customers(spark, d))
    sinks.land_bronze(raw, root, "customers", "2026-10-08")
    sinks.land_bronze(raw, root, "customers", "2026-10-07")
    landed = readers.read_bronze(spark, root, "customers", schemas.CUSTOMERS)
    return landed.groupBy(readers.partition_date().alias("landed")).agg(F.count("*").alias("rows"))


@query("snk_05_idempotent_overwrite", with_tables("payments", """
SELECT year(payment_time)::INT AS year, month(payment_time)::INT AS month, count(*) AS rows, sum(amount)::DECIMAL(18,2) AS amount
FROM payments GROUP BY 1, 2"""))
def _(spark, d):
    path = work_dir(spark)
    dated = payments(spark, d).withColumns({"year": F.year("payment_time"), "month": F.month("payment_time")})
    sinks.write_partitioned(dated, path, ["year", "month"])
    sinks.write_partitioned(dated.filter("year = 1998"), path, ["year", "month"])  # rerun of one year
    return (spark.read.parquet(path).groupBy("year", "month")
            .agg(F.count("*").alias("rows"), F.sum("amount").cast("decimal(18,2)").alias("amount")))


@query("snk_06_file_count", with_tables("payments", """
SELECT year(payment_time)::INT AS year, count(*) AS rows, true AS few_files FROM payments GROUP BY 1"""))
def _(spark, d):
    path = work_dir(spark)
    dated = payments(spark, d).withColumn("year", F.year("payment_time"))
    sinks.write_partitioned(dated, path, ["year"], max_records_per_file=1_000_000)
    per_file = spark.read.parquet(path).groupBy("year", F.col("_metadata.file_path").alias("f")).agg(F.count("*").alias("n"))
    return per_file.groupBy("year").agg(F.sum("n").alias("rows"), (F.count("*") <= F.ceil(F.sum("n") / 1_000_000) + 1).alias("few_files"))


# The target is scaled down, so that a year takes several files; a year of one share may have a file of any size below.
@query("snk_06_sized_files", with_tables("payments", """
SELECT year(payment_time)::INT AS year, count(*) AS rows, sum(amount)::DECIMAL(18,2) AS amount, true AS sized FROM payments GROUP BY 1"""))
def _(spark, d):
    path, target = work_dir(spark), 50_000
    dated = materialize(payments(spark, d).withColumn("year", F.year("payment_time")), work_dir(spark))
    sinks.write_sized(dated, path, ["year"], ["payment_time"], target)
    files = spark.read.parquet(path).groupBy("year", F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("bytes")).agg(
        F.count("*").alias("n"), F.sum("amount").alias("amount"))
    sized = (F.max("bytes") <= 1.3 * target) & (F.count("*") <= F.ceil(F.sum("bytes") / (target / 3)))
    return files.groupBy("year").agg(F.sum("n").alias("rows"), F.sum("amount").cast("decimal(18,2)").alias("amount"), sized.alias("sized"))


# Files of 10 rows are joined; the rows stay.
@query("snk_06_compaction", with_tables("customers", """
SELECT customer_id, city, true AS fewer_files, true AS old_version_stays FROM customers"""))
def _(spark, d):
    root = work_dir(spark)
    merge.create_table(customers(spark, d).select("customer_id", "city"), root, "customer_id", rows_per_file=10)
    merge.compact(spark, root, "customer_id", target_bytes=1 << 20)
    files = [merge.manifest(spark, root, v).count() for v in (0, 1)]
    same = maintenance.verify_rows(merge.read_table(spark, root, 0), merge.read_table(spark, root, 1)).first().identical
    return merge.read_table(spark, root).withColumns({"fewer_files": F.lit(files[1] * 5 < files[0]), "old_version_stays": F.lit(same)})


@query("snk_07_truncate_and_reload", accepted("""
SELECT 'customers' AS table_name, count(*) AS rows FROM customers_ok UNION ALL SELECT 'drivers', count(*) FROM drivers_ok
UNION ALL SELECT 'rides', count(*) FROM rides_ok UNION ALL SELECT 'payments', count(*) FROM payments_ok"""))
def _(spark, d):
    root = work_dir(spark)
    load.load_all(tables(spark, d), root)
    return maintenance.row_counts({n: spark.read.parquet(f"{root}/{n}") for n in schemas.DATASETS})


@query("snk_08_clustered_layout", silver("""
SELECT pickup_city, count(*) AS rides, min(request_time) AS first_request, sum(fare)::DECIMAL(18,2) AS fare
FROM silver_rides GROUP BY pickup_city"""))
def _(spark, d):
    path = work_dir(spark)
    sinks.save_clustered(stores.gold(spark, d)["fact_rides"], path, "location_key", "request_time")
    per_place = (spark.read.parquet(path).groupBy("location_key")
                 .agg(F.count("*").alias("n"), F.min("request_time").alias("t"), F.sum("fare").alias("fare")))
    return (per_place.join(stores.gold(spark, d)["dim_location"], "location_key").groupBy(F.col("city").alias("pickup_city"))
            .agg(F.sum("n").alias("rides"), F.min("t").alias("first_request"), F.sum("fare").cast("decimal(18,2)").alias("fare")))


# Rides by customer, whose hottest ones are dealt to several buckets, against payments: an exchange-free join of two facts.
@query("snk_08_bucketed_join", silver("""
SELECT r.ride_status, p.payment_status, count(*) AS pairs, sum(p.amount)::DECIMAL(18,2) AS amount
FROM silver_rides r JOIN silver_payments p USING (customer_id) GROUP BY 1, 2"""))
def _(spark, d):
    g = stores.gold(spark, d)
    names = tuple(f"rf_{n}_{uuid.uuid4().hex}" for n in ("rides", "payments"))
    bucketed.save_for_join(g["fact_rides"].select("customer_key", "request_time", "ride_key", "ride_status"),
                           g["fact_payments"].select("customer_key", "payment_time", "payment_status", "amount"),
                           names, work_dir(spark), "customer_key", ("request_time", "payment_time"), buckets=8, share=0.01)
    joined = bucketed.join_stored(spark, names, "customer_key")
    return (joined.groupBy("ride_status", "payment_status")
            .agg(F.count("*").alias("pairs"), F.sum("amount").cast("decimal(18,2)").alias("amount")))


@query("snk_09_pending_partitions", with_tables("rides payments", """
SELECT strftime(month, '%Y') AS year, strftime(month, '%m') AS month FROM (
  SELECT DISTINCT date_trunc('month', payment_time) AS month FROM payments
  EXCEPT SELECT DISTINCT date_trunc('month', request_time) FROM rides WHERE pickup_city = 'Pune' AND pickup_area = 'Area 3')"""))
def _(spark, d):
    landed = readers.read_bronze(spark, _land_by_month(spark, d), "payments", schemas.PAYMENTS).select("year", "month")
    processed = (rides(spark, d).filter("pickup_city = 'Pune' AND pickup_area = 'Area 3'")
                 .select(F.date_format("request_time", "yyyy").alias("year"), F.date_format("request_time", "MM").alias("month")))
    return maintenance.pending_partitions(landed, processed, ["year", "month"])


# Read once: all files of the first landing but those of May, whose entry names another time. Then files of June come into folders that were read.
@query("snk_09_file_ledger", with_tables("payments", """
SELECT 1 AS pass, month(payment_time)::INT AS month, count(*) AS rows FROM payments GROUP BY ALL
UNION ALL SELECT 2, 5, count(*) FROM payments WHERE month(payment_time) = 5 HAVING count(*) > 0
UNION ALL SELECT 2, 6, count(*) FROM payments WHERE month(payment_time) = 6 AND payment_method = 'Cash' HAVING count(*) > 0"""))
def _(spark, d):
    root = work_dir(spark)
    rows = as_text(payments(spark, d)).withColumn("month", F.month(F.col("payment_time").cast("timestamp_ntz")))
    parts = []

    def read_pending(number: int) -> None:
        files = ledger.list_files(spark, f"{root}/in")
        due = materialize(ledger.pending_files(files, ledger.read_ledger(spark, f"{root}/ledger")), f"{root}/due/{number}")
        names = [r.file for r in due.collect()]
        if names:
            read = readers.read_raw(spark, names, schemas.PAYMENTS, lenient=True)
            month = F.regexp_extract(F.col("_metadata.file_path"), "/month=([0-9]+)/", 1).cast("int")
            parts.append(read.groupBy(month.alias("month")).agg(F.count("*").alias("rows")).select(F.lit(number).alias("pass"), "month", "rows"))
        modified = F.when(F.col("file").contains("/month=5/") & (F.lit(number) == 1), F.col("modified") - 1).otherwise(F.col("modified"))
        ledger.record(due.withColumn("modified", modified).withColumn("entry", F.lit(f"run-{number}")), f"{root}/ledger")

    def land(df) -> None:
        df.repartition("month").write.mode("append").partitionBy("month").option("header", True).csv(f"{root}/in")

    land(rows)
    read_pending(1)
    land(rows.filter("month = 6 AND payment_method = 'Cash'"))
    read_pending(2)
    read_pending(3)
    return _union(parts)


@query("snk_10_verify_landing", with_tables("customers", """
SELECT 'same' AS tree, 'ok' AS status, count(DISTINCT city) AS files FROM customers
UNION ALL SELECT 'other', 'missing', count(DISTINCT city) FROM customers
UNION ALL SELECT 'other', 'extra', count(DISTINCT city) FROM customers"""))
def _(spark, d):
    trees = [work_dir(spark), work_dir(spark)]
    for path in trees:  # one file per city; the second tree gets other file names
        as_text(customers(spark, d)).repartition("city").write.partitionBy("city").option("header", True).csv(path)
    found = _union(maintenance.verify_landing(spark, trees[0], other).withColumn("tree", F.lit(label))
                   for label, other in (("same", trees[0]), ("other", trees[1])))
    return found.groupBy("tree", "status").agg(F.count("*").alias("files"))


@query("snk_11_retention", with_tables("rides", """
SELECT layer, dataset, partition_date, date_diff('day', partition_date, DATE '2001-09-01') AS age_days,
  CASE layer WHEN 'quarantine' THEN 'expire' ELSE 'archive' END AS action
FROM (SELECT DISTINCT CASE WHEN ride_status = 'no_show' THEN 'quarantine' WHEN ride_status = 'completed' THEN 'bronze' ELSE 'gold' END AS layer,
  'rides' AS dataset, request_time::DATE AS partition_date FROM rides)
WHERE (layer = 'quarantine' AND age_days > 30) OR (layer = 'bronze' AND age_days > 90)"""))
def _(spark, d):
    partitions = rides(spark, d).select(
        F.when(F.col("ride_status") == "no_show", "quarantine").when(F.col("ride_status") == "completed", "bronze")
        .otherwise("gold").alias("layer"),
        F.lit("rides").alias("dataset"), F.to_date("request_time").alias("partition_date")).distinct()
    return maintenance.retention_candidates(partitions, "2001-09-01")


@query("snk_12_table_info", with_tables("payments", """
SELECT 'rf_payments' AS table_name, column_name, filled FROM (SELECT count(payment_id) AS payment_id, count(ride_id) AS ride_id,
  count(customer_id) AS customer_id, count(amount) AS amount, count(payment_method) AS payment_method,
  count(payment_status) AS payment_status, count(payment_time) AS payment_time, count(tip_amount) AS tip_amount FROM payments)
UNPIVOT (filled FOR column_name IN (payment_id, ride_id, customer_id, amount, payment_method, payment_status, payment_time, tip_amount))"""))
def _(spark, d):
    payments(spark, d).createOrReplaceTempView("rf_payments")
    info = maintenance.table_info(spark, ["rf_payments"])
    names = schemas.PAYMENTS.names
    filled = spark.table("rf_payments").agg(*[F.count(c).alias(c) for c in names]).unpivot([], names, "column_name", "filled")
    return info.join(filled, "column_name").select("table_name", "column_name", "filled")


@query("dq_13_audit_log", with_tables("payments customers", """
SELECT 'ingestion_completed' AS event, 'payments' AS dataset, count(*) AS rows, 'bronze-20261008-120000-0a1b2c3d' AS run_id FROM payments
UNION ALL SELECT 'ingestion_completed', 'customers', count(*), 'bronze-20261008-120000-0a1b2c3d' FROM customers"""))
def _(spark, d):
    import datetime as dt

    root = work_dir(spark)
    run = sinks.run_id("bronze", dt.datetime(2026, 10, 8, 12), "0a1b2c3d")
    counted = maintenance.row_counts({"payments": payments(spark, d), "customers": customers(spark, d)}).collect()
    events = [("ingestion_completed", r.table_name, r.rows, 0) for r in counted]
    for _run in range(2):  # logging the same run again replaces its records
        sinks.audit_log(spark, root, run, "2026-10-08 12:00:00", events)
    return spark.read.parquet(f"{root}/audit").select("event", "dataset", "rows", "run_id")


# --- Silver steps --------------------------------------------------------------------------------

_DIRTY_DISTANCE = "CASE WHEN distance_km = 13 THEN 'n/a' ELSE distance_km::VARCHAR END"


@query("sv_01_conform", with_tables("rides", f"""
SELECT ride_id, TRY_CAST({_DIRTY_DISTANCE} AS DECIMAL(10,2)) AS distance_km, fare::DECIMAL(10,2) AS fare, request_time, dropoff_time,
  CASE WHEN distance_km = 13 THEN 'MALFORMED_VALUE' END AS code FROM rides"""))
def _(spark, d):
    raw = as_text(rides(spark, d)).withColumn(
        "distance_km", F.when(F.col("distance_km") == "13.00", "n/a").otherwise(F.col("distance_km")))
    return steps.conform(raw, schemas.RIDES).select(
        "ride_id", "distance_km", "fare", "request_time", "dropoff_time", F.try_element_at("failures", F.lit(1))["code"].alias("code"))


@query("sv_02_standardize_city", with_tables("rides", f"""
SELECT {clean_city('pickup_city')} AS pickup_city, {clean_city('dropoff_city')} AS dropoff_city, count(*) AS rides FROM rides GROUP BY 1, 2"""))
def _(spark, d):
    return (steps.standardize_city(rides(spark, d), ["pickup_city", "dropoff_city"])
            .groupBy("pickup_city", "dropoff_city").agg(F.count("*").alias("rides")))


@query("sv_03_null_policy", with_tables("payments", """
SELECT payment_id, CASE WHEN payment_status = 'failed' THEN 0.00 ELSE tip_amount END::DECIMAL(12,2) AS tip_amount, amount FROM payments"""))
def _(spark, d):
    gaps = payments(spark, d).withColumn("tip_amount", F.when(F.col("payment_status") != "failed", F.col("tip_amount")))
    return steps.apply_null_policy(gaps, steps.NULL_DEFAULTS["payments"]).select("payment_id", "tip_amount", "amount")


_RIDE_DEDUPE_ORDER = ("request_time, customer_id, driver_id, pickup_city, pickup_area, dropoff_city, dropoff_area, pickup_lat, "
                      "pickup_lon, dropoff_lat, dropoff_lon, pickup_time NULLS FIRST, dropoff_time NULLS FIRST, distance_km, fare, "
                      "surge_multiplier, ride_status")


@query("sv_04_dedupe", with_tables("rides", f"""
SELECT ride_id, driver_id, request_time, fare, distance_km FROM rides
QUALIFY row_number() OVER (PARTITION BY ride_id ORDER BY {_RIDE_DEDUPE_ORDER}) = 1"""))
def _(spark, d):
    return (first_per_key(rides(spark, d), ["ride_id"], ["request_time"])
            .select("ride_id", "driver_id", "request_time", "fare", "distance_km"))


@query("sv_04_mark_duplicates", with_tables("rides", f"""
SELECT ride_id, request_time, fare,
  row_number() OVER (PARTITION BY ride_id ORDER BY {_RIDE_DEDUPE_ORDER}) = 1 AS is_first FROM rides"""))
def _(spark, d):
    return mark_first(rides(spark, d), ["ride_id"], ["request_time"]).select("ride_id", "request_time", "fare", "is_first")


@query("sv_05_valid_and_quarantine", silver("""
SELECT 'valid' AS side, count(*) AS rows FROM silver_rides
UNION ALL SELECT 'quarantine', (SELECT count(*) FROM rides) - (SELECT count(*) FROM silver_rides)"""))
def _(spark, d):
    parents = stores.silver(spark, d)
    cleaned = steps.clean(as_text(rides(spark, d)), "rides")
    valid, bad = quality.split(cleaned, quality.silver_rules("rides"),
                               quality.foreign_keys("rides", parents), quality.unique_rules("rides"), stage_in=work_dir(spark))
    return _union(f.agg(F.lit(s).alias("side"), F.count("*").alias("rows")) for s, f in (("valid", valid), ("quarantine", bad)))


@query("sv_06_derive_time", silver("""
SELECT ride_id, request_time::DATE AS ride_date, hour(request_time)::INT AS ride_hour, (dayofweek(request_time) + 1)::INT AS day_of_week,
  month(request_time)::INT AS month, year(request_time)::INT AS year, date_sub('minute', request_time, pickup_time) AS wait_minutes,
  date_sub('minute', pickup_time, dropoff_time) AS trip_minutes FROM silver_rides"""))
def _(spark, d):
    return stores.silver(spark, d)["rides"].select(
        "ride_id", "ride_date", "ride_hour", "day_of_week", "month", "year", "wait_minutes", "trip_minutes")


@query("sv_07_mask", silver(rf"""
SELECT customer_id, substr(first_name, 1, 1) || '***' AS first_name, substr(last_name, 1, 1) || '***' AS last_name,
  sha256(email || '{SALT}') AS email, '***-***-' || right(regexp_replace(phone, '\D', '', 'g'), 4) AS phone,
  city, signup_date, is_active = 'True' AS is_active FROM silver_customers"""))
def _(spark, d):
    return stores.silver(spark, d)["customers"].select(*schemas.CUSTOMERS.names)


@query("sv_08_obfuscate_geo", silver(f"""
SELECT ride_id, {_geohash_sql('pickup_lat', 'pickup_lon')} AS pickup_cell, {_geohash_sql('dropoff_lat', 'dropoff_lon')} AS dropoff_cell
FROM silver_rides"""))
def _(spark, d):
    return stores.silver(spark, d)["rides"].select("ride_id", "pickup_cell", "dropoff_cell")


@query("sv_09_lineage", with_tables("payments", """
SELECT payment_id, 'part' AS source, 'run-1' AS _pipeline_run_id, TIMESTAMP '2026-09-01 08:15:00' AS _processed_timestamp FROM payments"""))
def _(spark, d):
    path = work_dir(spark)
    sinks.write_csv(payments(spark, d), path)
    traced = steps.with_lineage(readers.read_raw(spark, path, schemas.PAYMENTS, lenient=True), "run-1", "2026-09-01 08:15:00")
    name = F.substring(F.element_at(F.split("_source_file_uri", "/"), -1), 1, 4)
    return traced.select("payment_id", name.alias("source"), "_pipeline_run_id", "_processed_timestamp")


@query("sv_10_silver_layout", silver("""
SELECT '2026-10-08' AS ingest_date, count(*) AS rows, count(DISTINCT ride_id) AS keys FROM silver_rides"""))
def _(spark, d):
    path = work_dir(spark)
    for _run in range(2):
        sinks.write_date(stores.silver(spark, d)["rides"].drop("ingest_date"), path, "2026-10-08")
    back = spark.read.parquet(path)
    return (back.groupBy(F.col("ingest_date").cast("string").alias("ingest_date"), "ride_id").agg(F.count("*").alias("n"))
            .groupBy("ingest_date").agg(F.sum("n").alias("rows"), F.count("*").alias("keys")))


@query("sv_11_align_schema", with_tables("payments", """
SELECT payment_id, ride_id, customer_id, amount, payment_method, payment_status, payment_time, NULL::DECIMAL(10,2) AS tip_amount FROM payments"""))
def _(spark, d):
    old = payments(spark, d).withColumnRenamed("payment_method", "method").drop("tip_amount").withColumn("terminal", F.lit("T1"))
    return steps.align_schema(old, schemas.PAYMENTS, {"method": "payment_method"})


@query("dq_09_reprocess", silver("""
SELECT payment_id, ride_id, amount::DECIMAL(10,2) AS amount FROM silver_payments""").replace("% 101 = 0 THEN -1 ", "% 101 = 0 THEN 1 "))
def _(spark, d):
    root, date, now = work_dir(spark), stores.INGEST_DATE, "2026-10-08 12:00:00"
    raw = stores.raw(spark, d)
    lake.land_all(raw, root, date)
    lake.bronze_to_silver(spark, root, date, "run-1", now, SALT)
    fixed = raw["payments"].filter("amount = '-1.00'").withColumn("amount", F.lit("1.00"))
    lake.reprocess(spark, root, "payments", fixed, date, "run-2", now, SALT)
    return lake.read_silver(spark, root, "payments").select("payment_id", "ride_id", "amount")


# --- star schema ---------------------------------------------------------------------------------


@query("gd_02_dim_customer", silver(f"""
SELECT {key('customer_id')} AS customer_key, substr(first_name, 1, 1) || '*** ' || substr(last_name, 1, 1) || '***' AS customer_name,
  city, signup_date FROM silver_customers"""))
def _(spark, d):
    return gold.dim_customer(stores.silver(spark, d)["customers"])


@query("gd_03_dim_driver", silver(f"""
SELECT {key('driver_id')} AS driver_key, substr(first_name, 1, 1) || '*** ' || substr(last_name, 1, 1) || '***' AS driver_name,
  city, vehicle_type, rating, join_date FROM silver_drivers"""))
def _(spark, d):
    return gold.dim_driver(stores.silver(spark, d)["drivers"])


_PLACES = f"""places AS (
  SELECT ride_id, pickup_city AS city, pickup_area AS area, {_geohash_sql('pickup_lat', 'pickup_lon')} AS cell FROM silver_rides
  UNION ALL SELECT ride_id, dropoff_city, dropoff_area, {_geohash_sql('dropoff_lat', 'dropoff_lon')} FROM silver_rides)"""


@query("gd_04_dim_location", silver(f"""
SELECT DISTINCT {key('city', 'area', 'cell')} AS location_key, city, area, cell FROM places""", _PLACES))
def _(spark, d):
    return gold.dim_location(stores.silver(spark, d)["rides"])


_DATE_COLUMNS = """strftime(day, '%Y%m%d')::INT AS date_key, day::DATE AS full_date, day(day)::INT AS day, month(day)::INT AS month,
  quarter(day)::INT AS quarter, year(day)::INT AS year, (dayofweek(day) + 1)::INT AS day_of_week, dayofweek(day) IN (0, 6) AS is_weekend"""


@query("gd_05_dim_date", silver(f"""
SELECT {_DATE_COLUMNS} FROM (SELECT unnest(generate_series(min(lo), max(hi), INTERVAL 1 DAY)) AS day FROM (
  SELECT min(request_time)::DATE AS lo, max(request_time)::DATE AS hi FROM silver_rides
  UNION ALL SELECT min(payment_time)::DATE, max(payment_time)::DATE FROM silver_payments))"""))
def _(spark, d):
    t = stores.silver(spark, d)
    return gold.dim_date_of((t["rides"], "request_time"), (t["payments"], "payment_time"))


_FACT_RIDES = f"""fact_rides AS (
  SELECT {key('ride_id')} AS ride_key, {key('customer_id')} AS customer_key, {key('driver_id')} AS driver_key,
    {key('pickup_city', 'pickup_area', _geohash_sql('pickup_lat', 'pickup_lon'))} AS location_key,
    {key('dropoff_city', 'dropoff_area', _geohash_sql('dropoff_lat', 'dropoff_lon'))} AS dropoff_location_key,
    strftime(request_time, '%Y%m%d')::INT AS date_key, request_time, pickup_time, dropoff_time,
    hour(request_time)::INT AS ride_hour, distance_km, fare, surge_multiplier, ride_status,
    year(request_time)::INT AS year, month(request_time)::INT AS month FROM silver_rides)"""


@query("gd_06_fact_rides", silver("SELECT * FROM fact_rides", _FACT_RIDES))
def _(spark, d):
    return gold.fact_rides(stores.silver(spark, d)["rides"]).drop(*steps.LINEAGE)


@query("gd_07_fact_payments", silver(f"""
SELECT {key('payment_id')} AS payment_key, {key('ride_id')} AS ride_key, {key('customer_id')} AS customer_key,
  strftime(payment_time, '%Y%m%d')::INT AS date_key, amount, tip_amount, payment_method, payment_status, payment_time,
  year(payment_time)::INT AS year, month(payment_time)::INT AS month FROM silver_payments"""))
def _(spark, d):
    return gold.fact_payments(stores.silver(spark, d)["payments"]).drop(*steps.LINEAGE)


def _missing(fact: str, key_name: str, value: str, lost: str) -> str:
    rows = f"silver_{fact.removeprefix('fact_')}"
    return (f"SELECT '{fact}' AS fact, '{key_name}' AS key_name, count(DISTINCT {value}) AS missing_keys, count(*) AS fact_rows "
            f"FROM {rows} r WHERE {lost}")


_LOST_CUSTOMER = "r.customer_id IN (SELECT customer_id FROM silver_customers WHERE city = 'Pune')"
_LOST_DRIVER = "r.driver_id IN (SELECT driver_id FROM silver_drivers WHERE vehicle_type = 'Bike')"
_PLACE = "{0}_city || '/' || {0}_area || '/' || " + _geohash_sql("{0}_lat", "{0}_lon")


# Rows are taken out of every table that a key points to; the facts keep theirs.
@query("gd_08_foreign_keys", silver(" UNION ALL ".join([
    _missing("fact_rides", "customer_key", "customer_id", _LOST_CUSTOMER), _missing("fact_rides", "customer_version", "customer_id", _LOST_CUSTOMER),
    _missing("fact_rides", "driver_key", "driver_id", _LOST_DRIVER), _missing("fact_rides", "driver_version", "driver_id", _LOST_DRIVER),
    _missing("fact_rides", "location_key", _PLACE.format("pickup"), "pickup_area = 'Area 3'"),
    _missing("fact_rides", "dropoff_location_key", _PLACE.format("dropoff"), "dropoff_area = 'Area 3'"),
    _missing("fact_rides", "date_key", "request_time::DATE", "month(request_time) = 6"),
    _missing("fact_payments", "customer_key", "customer_id", _LOST_CUSTOMER),
    _missing("fact_payments", "ride_key", "ride_id", "r.ride_id IN (SELECT ride_id FROM silver_rides WHERE ride_status = 'completed')"),
    _missing("fact_payments", "date_key", "payment_time::DATE", "month(payment_time) = 6")])))
def _(spark, d):
    g = stores.gold(spark, d)
    lost = {"dim_customer": "city = 'Pune'", "dim_customer_history": "city = 'Pune'", "dim_driver": "vehicle_type = 'Bike'",
            "dim_driver_history": "vehicle_type = 'Bike'", "dim_location": "area = 'Area 3'", "dim_date": "month = 6", "fact_rides": "ride_status = 'completed'"}
    return lake.foreign_keys(g, {name: df.where(f"NOT ({lost[name]})") for name, df in g.items() if name in lost})


@query("jn_10_unknown_keys", accepted(f"""
SELECT 'driver_key' AS key_name, count(DISTINCT driver_id) AS missing_keys, count(*) AS fact_rows FROM rides
WHERE driver_id NOT IN (SELECT driver_id FROM drivers_ok WHERE vehicle_type <> 'Bike')"""))
def _(spark, d):
    fact = rides(spark, d).select(gold.surrogate_key("driver_id").alias("driver_key"))
    known = quality.accepted(stores.evaluated(spark, d)["drivers"]).filter("vehicle_type <> 'Bike'")
    return gold.fk_violations(fact, {"driver_key": known.select(gold.surrogate_key("driver_id").alias("driver_key"))})


@query("jn_07_star_join", silver(f"""
SELECT d.vehicle_type, c.city AS customer_city, l.city AS ride_city, dayofweek(r.request_time) IN (0, 6) AS is_weekend,
  count(*) AS rides, {mean('r.fare')} AS avg_fare
FROM silver_rides r JOIN silver_drivers d USING (driver_id) JOIN silver_customers c ON c.customer_id = r.customer_id
JOIN (SELECT DISTINCT pickup_city AS city FROM silver_rides) l ON l.city = r.pickup_city GROUP BY ALL"""))
def _(spark, d):
    from rideflow.functions.numeric import mean as exact_mean

    g = stores.gold(spark, d)
    joined = gold.star(g["fact_rides"], {"driver_key": g["dim_driver"], "customer_key": g["dim_customer"],
                                         "location_key": g["dim_location"], "date_key": g["dim_date"]})
    return (joined.groupBy(F.col("driver_vehicle_type").alias("vehicle_type"), "customer_city",
                           F.col("location_city").alias("ride_city"), F.col("date_is_weekend").alias("is_weekend"))
            .agg(F.count("*").alias("rides"), exact_mean("fare").alias("avg_fare")))


# Dated snapshots of a driver: the vehicle type seen on each day with a ride, by the area of its first ride.
_SNAPSHOTS = """snapshots AS (
  SELECT driver_id, request_time::DATE AS day, min(pickup_city) AS base FROM rides GROUP BY 1, 2)"""


@query("wn_04_scd2", with_tables("rides", """
SELECT driver_id, base, day AS valid_from, lead(day) OVER w AS valid_to, lead(day) OVER w IS NULL AS is_current
FROM (SELECT *, lag(base) OVER (PARTITION BY driver_id ORDER BY day) AS previous FROM snapshots)
WHERE previous IS DISTINCT FROM base WINDOW w AS (PARTITION BY driver_id ORDER BY day)""", _SNAPSHOTS))
def _(spark, d):
    snapshots = rides(spark, d).groupBy("driver_id", F.to_date("request_time").alias("day")).agg(F.min("pickup_city").alias("base"))
    return history.scd2(snapshots, "driver_id", ["base"], "day")


@query("gd_09_scd2_dim_driver", with_tables("rides", f"""
SELECT {key('driver_id')} AS driver_key, base, day AS valid_from, lead(day) OVER w AS valid_to, lead(day) OVER w IS NULL AS is_current
FROM (SELECT *, lag(base) OVER (PARTITION BY driver_id ORDER BY day) AS previous FROM snapshots)
WHERE previous IS DISTINCT FROM base WINDOW w AS (PARTITION BY driver_id ORDER BY day)""", _SNAPSHOTS))
def _(spark, d):
    # Every ride is a delivery of the driver's record; several on one day are cut to the first.
    deliveries = rides(spark, d).select("driver_id", "request_time", F.col("pickup_city").alias("base"))
    versions = history.scd2(deliveries, "driver_id", ["base"], "request_time")
    return versions.select(gold.surrogate_key("driver_id").alias("driver_key"), "base", "valid_from", "valid_to", "is_current")


# What the three deliveries of the history lake say, and the versions they give.
_DELIVERED = """delivered AS (
  SELECT DATE '1996-01-01' AS day, customer_id AS id, CASE WHEN substr(customer_id, 2)::BIGINT % 3 = 0 THEN 'Delhi' ELSE city END AS value
  FROM silver_customers WHERE substr(customer_id, 2)::BIGINT % 5 <> 0
  UNION ALL SELECT DATE '1997-07-01', customer_id, CASE WHEN substr(customer_id, 2)::BIGINT % 3 = 1 THEN 'Pune' ELSE city END FROM silver_customers
  UNION ALL SELECT DATE '2026-10-08', customer_id, city FROM silver_customers
  UNION ALL SELECT DATE '1996-01-01', driver_id, CASE WHEN substr(driver_id, 2)::BIGINT % 2 = 0 THEN 'SUV' ELSE vehicle_type END FROM silver_drivers
  UNION ALL SELECT DATE '1997-07-01', driver_id, vehicle_type FROM silver_drivers
  UNION ALL SELECT DATE '2026-10-08', driver_id, vehicle_type FROM silver_drivers)"""
_VERSIONS = f"""versions AS (
  SELECT id, value, day AS valid_from, lead(day) OVER w AS valid_to, {key(key('id') + '::VARCHAR', 'day::VARCHAR')} AS version,
    CASE WHEN row_number() OVER w = 1 THEN DATE '0001-01-01' ELSE day END AS holds_from
  FROM (SELECT *, lag(value) OVER (PARTITION BY id ORDER BY day) AS previous FROM delivered)
  WHERE previous IS DISTINCT FROM value WINDOW w AS (PARTITION BY id ORDER BY day))"""


@query("gd_09_dim_histories", silver(f"""
SELECT CASE substr(id, 1, 1) WHEN 'C' THEN 'customer' ELSE 'driver' END AS entity, {key('id')} AS key, version, value, valid_from, valid_to,
  valid_to IS NULL AS is_current FROM versions""", _DELIVERED, _VERSIONS))
def _(spark, d):
    root = stores.history_root(spark, d, facts=False)
    return _union(lake.read_gold(spark, root, f"dim_{entity}_history").select(
        F.lit(entity).alias("entity"), F.col(f"{entity}_key").alias("key"), F.col(f"{entity}_version").alias("version"), F.col(value).alias("value"),
        "valid_from", "valid_to", "is_current") for entity, value in (("customer", "city"), ("driver", "vehicle_type")))


@query("gd_06_fact_versions", silver(f"""
SELECT {key('r.ride_id')} AS ride_key, c.version AS customer_version, d.version AS driver_version, c.value AS customer_city, d.value AS vehicle_type
FROM silver_rides r ASOF JOIN versions c ON c.id = r.customer_id AND r.request_time >= c.holds_from
ASOF JOIN versions d ON d.id = r.driver_id AND r.request_time >= d.holds_from""", _DELIVERED, _VERSIONS))
def _(spark, d):
    g = lake.gold_tables(spark, stores.history_root(spark, d))
    return (g["fact_rides"].join(g["dim_customer_history"].withColumnRenamed("city", "customer_city"), "customer_version")
            .join(g["dim_driver_history"], "driver_version").select("ride_key", "customer_version", "driver_version", "customer_city", "vehicle_type"))


@query("gd_10_upsert", with_tables("customers", """
SELECT customer_id, CASE WHEN is_active = 'False' THEN 'Delhi' ELSE city END AS city,
  CASE WHEN is_active = 'False' THEN 2 ELSE 1 END AS version FROM customers"""))
def _(spark, d):
    current = customers(spark, d).select("customer_id", "city", F.lit(1).alias("version"))
    changes = (customers(spark, d).filter("is_active = 'False'")
               .select("customer_id", F.lit("Delhi").alias("city"), F.lit(2).alias("version")))
    return history.upsert(current, changes, "customer_id", "version")


# A tenth of the customers moves, and some new ones come; two merges, of which the second brings an older row as well.
@query("gd_10_merge", with_tables("customers", """
SELECT customer_id, CASE WHEN n % 10 = 3 AND n < 700 THEN 'Delhi' ELSE city END AS city, CASE WHEN n % 10 = 3 AND n < 700 THEN 2 ELSE 1 END AS version
FROM (SELECT *, substr(customer_id, 2)::BIGINT AS n FROM customers)
UNION ALL SELECT 'N' || customer_id, city, 5 FROM customers WHERE substr(customer_id, 2)::BIGINT % 50 = 0"""))
def _(spark, d):
    root = work_dir(spark)
    number = F.substring("customer_id", 2, 20).cast("bigint")
    current = customers(spark, d).select("customer_id", "city", F.lit(1).alias("version"))
    merge.create_table(current, root, "customer_id", rows_per_file=100)
    moved = current.where((number % 10 == 3) & (number < 700)).withColumns({"city": F.lit("Delhi"), "version": F.lit(2)})
    new = current.where(number % 50 == 0).withColumns({"customer_id": F.concat(F.lit("N"), "customer_id"), "version": F.lit(5)})
    merge.merge_into(moved, root, "customer_id", "version", rows_per_file=100)
    merge.merge_into(new.unionByName(current.withColumns({"version": F.lit(0), "city": F.lit("old")})), root, "customer_id", "version", rows_per_file=100)
    return merge.read_table(spark, root)


@query("pv_09_pii_scan_gold", """
SELECT unnest(['customer_name', 'customer_name', 'customer_name', 'city', 'city', 'city']) AS column_name,
  unnest(['email', 'phone', 'card', 'email', 'phone', 'card']) AS pattern, 0 AS hits""")
def _(spark, d):
    return privacy.pii_scan(stores.gold(spark, d)["dim_customer"])


_SEEDED = {
    "dim_customer": ("city", "email", "customers WHERE city = 'Pune'"),
    "dim_customer_history": ("customer_name", "phone", "customers WHERE city = 'Delhi'"),
    "dim_driver": ("driver_name", "card", "drivers WHERE vehicle_type = 'Bike'"),
    "dim_driver_history": ("vehicle_type", "email", "drivers WHERE city = 'Pune'"),
    "fact_rides": ("ride_status", "phone", "rides WHERE ride_status = 'no_show'"),
    "fact_payments": ("payment_status", "card", "payments WHERE payment_method = 'Cash'"),
}


# Personal data is put into one column of every table but the calendar; card numbers whose check digit is wrong are put into another and count nothing.
@query("pv_09_pii_scan_gold_tables", silver(" UNION ALL ".join(
    f"SELECT '{table}' AS table_name, '{column}' AS column_name, '{kind}' AS pattern, count(*) AS hits FROM silver_{rows} HAVING count(*) > 0"
    for table, (column, kind, rows) in _SEEDED.items())
    + " UNION ALL SELECT 'dim_location', 'area', 'email', count(*) FROM (SELECT DISTINCT city, area, cell FROM ("
    + " UNION ALL ".join(f"SELECT {side}_city AS city, {side}_area AS area, {_geohash_sql(f'{side}_lat', f'{side}_lon')} AS cell FROM silver_rides"
                         for side in ("pickup", "dropoff")) + ") WHERE area = 'Area 3') HAVING count(*) > 0"))
def _(spark, d):
    samples = {"email": "see a.b@c-d.org now", "phone": "call +91 9876543210", "card": "4111 1111 1111 1112 4111-1111-1111-1111."}
    g = {name: df.drop(*steps.LINEAGE) for name, df in stores.gold(spark, d).items()}
    for table, (column, kind, rows) in _SEEDED.items():
        where = rows.split(" WHERE ")[1]
        g[table] = g[table].withColumn(column, F.when(F.expr(where), samples[kind]).otherwise(F.col(column)))
    g["dim_location"] = g["dim_location"].withColumn("area", F.when(F.col("area") == "Area 3", samples["email"]).otherwise(F.col("area")))
    g["dim_location"] = g["dim_location"].withColumn("city", F.concat("city", F.lit(" 4111111111111112")))
    return privacy.pii_scan_tables(g).filter("hits > 0")


# --- KPIs and lake queries -----------------------------------------------------------------------


# Half of the customers come late; the rides that they let through are of a later date.
@query("snk_04_affected_backfill", silver(f"""
SELECT {key('ride_id')} AS ride_key, {key('customer_id')} AS customer_key, fare FROM silver_rides"""))
def _(spark, d):
    root, now = work_dir(spark), "2026-10-08 12:00:00"
    raw = stores.raw(spark, d)
    half = raw["customers"].where(F.substring("customer_id", 2, 20).cast("bigint") % 2 == 0)
    lake.land_all({"customers": half, "drivers": raw["drivers"]}, root, "2026-10-06")
    lake.land_all({name: raw[name] for name in ("rides", "payments")}, root, "2026-10-08")
    lake.run(spark, root, "run-1", now, SALT)
    lake.land_all({"customers": raw["customers"]}, root, "2026-10-07")
    lake.run(spark, root, "run-2", now, SALT)
    return lake.read_gold(spark, root, "fact_rides").select("ride_key", "customer_key", "fare")


_ERASED = "substr(customer_id, 2)::BIGINT % 10 <> 7"


@query("pv_10_erase_lake", silver(" UNION ALL ".join(
    [f"SELECT 'bronze' AS layer, '{t}' AS dataset, count(*) AS rows FROM {t} WHERE {_ERASED}" for t in ("customers", "rides", "payments")]
    + [f"SELECT 'silver', '{t}', count(*) FROM silver_{t} WHERE {_ERASED}" for t in ("customers", "rides", "payments")]
    + [f"SELECT 'quarantine', '{t}', count(*) FROM {t} x WHERE {_ERASED} AND NOT EXISTS (SELECT 1 FROM silver_{t} s WHERE s.{k} = x.{k})"
       for t, k in (("customers", "customer_id"), ("payments", "payment_id"))]
    + [f"SELECT 'gold', '{n}', count(*) FROM silver_{t} WHERE {_ERASED}" for n, t in (
        ("dim_customer", "customers"), ("dim_customer_history", "customers"), ("fact_rides", "rides"), ("fact_payments", "payments"))])))
def _(spark, d):
    root = work_dir(spark)
    raw = stores.raw(spark, d)
    lake.land_all(raw, root, stores.INGEST_DATE)
    lake.run(spark, root, "run-1", "2026-10-08 12:00:00", SALT)
    lake.erase_subjects(spark, root, raw["customers"].where(F.substring("customer_id", 2, 20).cast("bigint") % 10 == 7))
    found = {("bronze", n): readers.read_bronze(spark, root, n, schemas.DATASETS[n]) for n in ("customers", "rides", "payments")}
    found |= {("silver", n): lake.read_silver(spark, root, n) for n in ("customers", "rides", "payments")}
    found |= {("quarantine", n): spark.read.parquet(f"{root}/quarantine/{n}").select("raw_record").distinct() for n in ("customers", "payments")}
    found |= {("gold", n): lake.read_gold(spark, root, n) for n in ("dim_customer", "dim_customer_history", "fact_rides", "fact_payments")}
    return _union(df.agg(F.count("*").alias("rows")).select(F.lit(layer).alias("layer"), F.lit(name).alias("dataset"), "rows") for (layer, name), df in found.items())


@query("kp_01_executive", silver(f"""
SELECT count(*) AS total_rides, sum(fare) FILTER (ride_status = 'completed')::DECIMAL(18,2) AS total_revenue, {mean('fare')} AS avg_fare,
  {percent("count(*) FILTER (ride_status = 'cancelled')", 'count(*)')} AS cancellation_rate_pct,
  {quotient("sum(date_sub('minute', pickup_time, dropoff_time))", "count(dropoff_time)")} AS avg_trip_minutes FROM silver_rides"""))
def _(spark, d):
    return kpis.executive(stores.silver(spark, d))


@query("kp_02_revenue_by_period", silver("""
SELECT 'day' AS grain, request_time::DATE AS period, sum(fare)::DECIMAL(18,2) AS revenue FROM silver_rides WHERE ride_status = 'completed' GROUP BY 2
UNION ALL SELECT 'month', date_trunc('month', request_time)::DATE, sum(fare)::DECIMAL(18,2) FROM silver_rides WHERE ride_status = 'completed' GROUP BY 2"""))
def _(spark, d):
    return kpis.revenue_by_period(stores.silver(spark, d))


@query("kp_03_cancellation_by_place", silver(f"""
SELECT pickup_city, pickup_area, count(*) AS total_rides, count(*) FILTER (ride_status = 'cancelled') AS cancellations,
  {percent("count(*) FILTER (ride_status = 'cancelled')", 'count(*)')} AS cancellation_rate_pct FROM silver_rides GROUP BY 1, 2"""))
def _(spark, d):
    return kpis.cancellation_by_place(stores.silver(spark, d))


@query("kp_04_driver_ranking", silver("""
SELECT driver_id, completed_rides, earnings, city, rank() OVER (PARTITION BY city ORDER BY completed_rides DESC) AS city_rank
FROM (SELECT driver_id, count(*) AS completed_rides, sum(fare)::DECIMAL(18,2) AS earnings FROM silver_rides
  WHERE ride_status = 'completed' GROUP BY driver_id) JOIN (SELECT driver_id, city FROM silver_drivers) USING (driver_id)"""))
def _(spark, d):
    return kpis.driver_ranking(stores.silver(spark, d))


@query("kp_04_city_ranking", silver("""
SELECT pickup_city, count(*) AS total_rides, sum(fare)::DECIMAL(18,2) AS revenue, dense_rank() OVER (ORDER BY count(*) DESC) AS demand_rank
FROM silver_rides GROUP BY pickup_city"""))
def _(spark, d):
    return kpis.city_ranking(stores.silver(spark, d))


@query("kp_05_demand_trend", silver("""
SELECT day, rides, ((2 * 100 * s + n) // nullif(2 * n, 0) * 0.01)::DECIMAL(18,2) AS rolling_avg FROM (
  SELECT day, rides, (sum(rides) OVER w)::HUGEINT AS s, count(*) OVER w AS n FROM daily
  WINDOW w AS (ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))""", """daily AS (
  SELECT day::DATE AS day, count(ride_id) AS rides
  FROM (SELECT unnest(generate_series(min(request_time)::DATE, max(request_time)::DATE, INTERVAL 1 DAY)) AS day FROM silver_rides)
  LEFT JOIN silver_rides ON request_time::DATE = day::DATE GROUP BY 1)"""))
def _(spark, d):
    return kpis.demand_trend(stores.silver(spark, d))


@query("kp_06_demand_by_cell", silver(f"""
SELECT {_geohash_sql('pickup_lat', 'pickup_lon')} AS cell, hour(request_time)::INT AS hour, count(*) AS rides,
  {mean('surge_multiplier')} AS avg_surge FROM silver_rides GROUP BY 1, 2"""))
def _(spark, d):
    return kpis.demand_by_cell(stores.silver(spark, d))


@query("lk_01_city_demand", silver(f"""
SELECT pickup_city AS city, count(*) AS total_rides, {mean('fare')} AS avg_fare FROM silver_rides GROUP BY 1"""))
def _(spark, d):
    return kpis.city_demand(stores.gold(spark, d))


@query("lk_02_peak_hours", silver("SELECT hour(request_time)::INT AS ride_hour, count(*) AS demand FROM silver_rides GROUP BY 1"))
def _(spark, d):
    return kpis.peak_hours(stores.gold(spark, d))


@query("lk_03_pruned_and_full", silver(f"""
SELECT 'full' AS scan, count(*) AS rides, {mean('fare')} AS avg_fare FROM silver_rides
UNION ALL SELECT 'pruned', count(*), {mean('fare')} FROM silver_rides WHERE request_time >= TIMESTAMP '1997-06-01' AND request_time < TIMESTAMP '1997-07-01'"""))
def _(spark, d):
    fact = stores.gold(spark, d)["fact_rides"]
    return _union([kpis.month_totals(fact).withColumn("scan", F.lit("full")),
                   kpis.month_totals(fact, 1997, 6).withColumn("scan", F.lit("pruned"))])
