import csv
import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rideflow import schemas
from rideflow.operators import gold, privacy, quality
from rideflow.plans import lake, load, views
from rideflow.sources import maintenance, readers, sinks
from rideflow.sources.testdata import as_text, tables
from rideflow.sources.workdir import work_dir
from tests.conftest import plan, rows

SALT = "s"
AT = "2026-10-08 12:00:00"


@pytest.fixture(scope="module")
def raw(spark, sf_dir):
    return {n: as_text(df) for n, df in tables(spark, sf_dir).items()}


@pytest.fixture(scope="module")
def root(spark, raw):
    path = work_dir(spark)
    lake.land_all(raw, path, "2026-10-08")
    lake.run(spark, path, "run-1", AT, SALT)
    return path


def content(df):
    return maintenance.table_fingerprint(df).first()


def test_pipeline_is_complete(spark, raw, root):
    silver = lake.read_silver(spark, root, "rides")
    kept = silver.count()
    lost = spark.read.parquet(f"{root}/quarantine/rides").select("raw_record").count()
    assert 0 < kept and lost > 0
    assert lake.check_silver(spark, root)["row_count"] == kept
    lake.check_gold(spark, root)
    assert lake.pending_dates(spark, root) == []


def test_rerun_changes_nothing(spark, root):
    before = {n: content(df) for n, df in lake.gold_tables(spark, root).items()}
    lake.bronze_to_silver(spark, root, "2026-10-08", "run-1", AT, SALT)
    lake.silver_to_gold(spark, root, ("2026-10-08", "2026-10-08"))
    assert {n: content(df) for n, df in lake.gold_tables(spark, root).items()} == before


def test_gold_has_no_personal_data(spark, root):
    for name, df in lake.gold_tables(spark, root).items():
        assert not {"email", "phone", "first_name", "customer_id", "driver_id", "ride_id", "pickup_lat"} & set(df.columns), name
        hits = privacy.pii_scan(df.drop(*[c for c in df.columns if c.startswith("_")])).filter("hits > 0")
        assert hits.count() == 0, name


def test_valid_and_rejected_add_up(spark, root):
    judged = lake.bronze_to_silver(spark, root, "2026-10-08", "run-1", AT, SALT)
    assert all(r.balanced for r in lake.row_totals(judged).collect())


def test_second_date_rejects_rides_loaded_before(spark, raw):
    path = work_dir(spark)
    lake.land_all(raw, path, "2026-10-08")
    lake.run(spark, path, "run-1", AT, SALT)
    kept = lake.read_silver(spark, path, "rides").count()
    lake.land_all(raw, path, "2026-10-09")
    assert lake.run(spark, path, "run-2", AT, SALT) == ["2026-10-09"]
    assert lake.read_silver(spark, path, "rides").count() == kept
    assert lake.read_gold(spark, path, "dim_customer").groupBy("customer_key").count().filter("count > 1").count() == 0


def test_reprocess_replaces_corrected_rows(spark, raw):
    path = work_dir(spark)
    lake.land_all(raw, path, "2026-10-08")
    lake.run(spark, path, "run-1", AT, SALT)
    kept = lake.read_silver(spark, path, "rides").count()
    known = raw["rides"].groupBy("ride_id").count().filter("count = 1").select("ride_id")
    wrong = raw["rides"].filter("CAST(distance_km AS DECIMAL(10,2)) < 0 AND CAST(fare AS DECIMAL(10,2)) > 0 AND CAST(pickup_lat AS DECIMAL(10,6)) < 90 "
                                "AND (dropoff_time IS NULL OR dropoff_time > pickup_time)").join(known, "ride_id", "left_semi")
    parents = lake.read_silver(spark, path, "customers"), lake.read_silver(spark, path, "drivers")
    wrong = wrong.join(parents[0], "customer_id", "left_semi").join(parents[1], "driver_id", "left_semi").select(*schemas.RIDES.names)
    n = wrong.count()
    assert n > 0
    lake.reprocess(spark, path, "rides", wrong.withColumn("distance_km", F.lit("5.00")), "2026-10-08", "run-2", AT, SALT)
    assert lake.read_silver(spark, path, "rides").count() == kept + n


def test_erased_subjects_are_gone_everywhere(spark, raw):
    path = work_dir(spark)
    lake.land_all(raw, path, "2026-10-08")
    lake.run(spark, path, "run-1", AT, SALT)
    who = raw["customers"].orderBy("customer_id").limit(3).select("customer_id")
    touched = lake.erase_subjects(spark, path, who)
    assert touched["customers"] == touched["rides"] == ["2026-10-08"]
    for dataset in ("customers", "rides", "payments"):
        left = [readers.read_bronze(spark, path, dataset, schemas.DATASETS[dataset]), lake.read_silver(spark, path, dataset),
                spark.read.parquet(f"{path}/quarantine/{dataset}").select(F.get_json_object("raw_record", "$.customer_id").alias("customer_id"))]
        for df in left:
            assert df.join(who, "customer_id", "left_semi").count() == 0
    lake.check_gold(spark, path)
    ids = {r[0] for r in who.select(gold.surrogate_key("customer_id")).collect()}
    assert lake.read_gold(spark, path, "dim_customer").filter(F.col("customer_key").isin(*ids)).count() == 0
    assert lake.read_gold(spark, path, "fact_rides").filter(F.col("customer_key").isin(*ids)).count() == 0


def test_bronze_scan_prunes_directories(spark, raw):
    path = work_dir(spark)
    for date in ("2026-10-07", "2026-10-08", "2026-11-01"):
        sinks.land_bronze(raw["payments"].limit(5), path, "payments", date)
    df = readers.read_bronze(spark, path, "payments", schemas.PAYMENTS, ("2026-10-08", "2026-10-31"))
    assert [r.landed for r in df.select(readers.partition_date().alias("landed")).distinct().collect()] == ["2026-10-08"]
    assert "PartitionFilters: [(concat_ws" in plan(df).replace("\n", " ")
    assert {r.month for r in df.select("month").collect()} == {"10"}
    with pytest.raises(ValueError):
        sinks.land_bronze(raw["payments"], path, "payments", "8/10/2026")


def test_gold_fact_prunes_months(spark, root):
    df = lake.read_gold(spark, root, "fact_rides").filter("year = 1997 AND month = 6")
    assert "PartitionFilters: [isnotnull(year" in plan(df)


def test_strict_read_fails_and_lenient_keeps(spark, tmp_path):
    text = "payment_id,ride_id,customer_id,amount,payment_method,payment_status,payment_time,tip_amount\n" \
           "p1,r1,c1,banana,UPI,completed,2024-01-01 10:00:00,\n"
    (tmp_path / "p.csv").write_text(text)
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_raw(spark, str(tmp_path), schemas.PAYMENTS).select("payment_id").collect()
    row = readers.read_raw(spark, str(tmp_path), schemas.PAYMENTS, lenient=True).first()
    assert row.amount == "banana" and row.tip_amount is None


def test_csv_empty_and_null(spark, tmp_path):
    df = spark.createDataFrame([(" a ", ""), (None, "b")], "x string, y string")
    sinks.write_csv(df, str(tmp_path / "c"))
    back = spark.read.options(**readers.CSV_OPTIONS).csv(str(tmp_path / "c"))
    assert sorted(map(str, map(tuple, back.collect()))) == sorted(map(str, [(" a ", ""), (None, "b")]))


def test_json_array_read(spark, tmp_path):
    (tmp_path / "d.json").write_text('[{"payment_id": "p1", "amount": 1.5, "payment_time": "2024-01-01T10:00:00"}, {"payment_id": "p2"}]')
    got = rows(readers.read_json(spark, str(tmp_path / "d.json"), schemas.PAYMENTS), "payment_id")
    assert [g["payment_id"] for g in got] == ["p1", "p2"]
    assert got[0]["payment_time"] == dt.datetime(2024, 1, 1, 10) and str(got[0]["amount"]) == "1.50"


def test_verify_landing_statuses(spark, tmp_path):
    for side, files in (("src", {"a.csv": "1\n2\n", "b.csv": "x\n", "c.csv": "same\n", "d.csv": "abcd\n"}),
                        ("dst", {"a.csv": "1\n2\n3\n", "c.csv": "same\n", "d.csv": "abce\n", "e.csv": "new\n"})):
        (tmp_path / side / "sub").mkdir(parents=True)
        for name, body in files.items():
            (tmp_path / side / "sub" / name).write_text(body)
    got = {r.file: r.status for r in maintenance.verify_landing(spark, str(tmp_path / "src"), str(tmp_path / "dst")).collect()}
    assert got == {"sub/a.csv": "size_mismatch", "sub/b.csv": "missing", "sub/c.csv": "ok", "sub/d.csv": "checksum_mismatch", "sub/e.csv": "extra"}


def test_verify_landing_sees_order_line_ends_empty_files_and_blanks_in_names(spark, tmp_path):
    long = [f"line {i}" for i in range(400_000)]
    for side, files in (("src", {"cr.csv": "1\n2\n", "cut.csv": "x\n", "none.csv": "", "both.csv": "", "back.csv": "\n".join(long)}),
                        ("dst", {"cr.csv": "1\r2\r", "cut.csv": "", "both.csv": "", "back.csv": "\n".join(reversed(long))})):
        folder = tmp_path / side / "city=New Delhi+a%b"
        folder.mkdir(parents=True)
        (folder / "same.csv").write_text("\n".join(long))
        for name, body in files.items():
            (folder / name).write_bytes(body.encode())
    found = maintenance.verify_landing(spark, str(tmp_path / "src"), str(tmp_path / "dst"))
    got = {r.file.removeprefix("city=New Delhi+a%b/"): r.status for r in found.collect()}
    assert got == {"cr.csv": "checksum_mismatch", "cut.csv": "size_mismatch", "none.csv": "missing", "both.csv": "ok",
                   "back.csv": "checksum_mismatch", "same.csv": "ok"}


def test_csv_of_other_writers(spark, tmp_path):
    values = ['say "hi", you', 'the "big" one', "back\\slash", "a,b", " blank ", ""]
    with open(tmp_path / "x.csv", "w", newline="") as file:
        writer = csv.writer(file)
        writer.writerow(["k", "v"])
        writer.writerows((i, v) for i, v in enumerate(values))
    schema = T.StructType().add("k", T.IntegerType()).add("v", T.StringType())
    for lenient in (True, False):
        got = readers.read_raw(spark, str(tmp_path / "x.csv"), schema, lenient).collect()
        assert [r.v or "" for r in got] == values
    sinks.write_csv(spark.createDataFrame(list(enumerate(values)), schema), str(tmp_path / "own"))
    assert sorted((r.k, r.v) for r in readers.read_raw(spark, str(tmp_path / "own"), schema).collect()) == list(enumerate(values))


def test_line_breaks_are_refused_or_kept(spark, tmp_path):
    schema = T.StructType().add("k", T.IntegerType()).add("v", T.StringType())
    df = spark.createDataFrame([(1, "a\nb")], schema)
    with pytest.raises(Exception, match="line break"):
        sinks.write_csv(df, str(tmp_path / "torn"))
    sinks.write_csv(df, str(tmp_path / "whole"), line_breaks=True)
    assert [tuple(r) for r in readers.read_raw(spark, str(tmp_path / "whole"), schema, line_breaks=True).collect()] == [(1, "a\nb")]


def test_order_of_processing_does_not_matter(spark, raw):
    days = ["2026-10-07", "2026-10-08"]
    some = {"customers": raw["customers"].filter("pmod(hash(customer_id), 2) = 0"), "drivers": raw["drivers"],
            "rides": raw["rides"].filter("pmod(hash(ride_id), 3) = 0")}  # no payments on the first day
    landings = {days[0]: some, days[1]: raw}
    results = []
    for order in (days, days[::-1]):
        path = work_dir(spark)
        for day in order:
            lake.land_all(landings[day], path, day)
            assert day in lake.run(spark, path, "run", AT, SALT)
        assert lake.pending_dates(spark, path) == []
        silver = {n: lake.read_silver(spark, path, n) for n in ("rides", "payments")}
        assert silver["rides"].groupBy("ride_id").count().filter("count > 1").isEmpty()
        facts = lake.gold_tables(spark, path)
        assert facts["fact_rides"].count() == silver["rides"].count()
        results.append([content(df.select(*[c for c in df.columns if not c.startswith("_")])) for df in silver.values()]
                       + [content(facts[n].select(*[c for c in facts[n].columns if not c.startswith("_")])) for n in ("fact_rides", "fact_payments")])
    assert results[0] == results[1]


def test_dynamic_overwrite_keeps_other_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "v int, year int, month int"
    sinks.write_partitioned(spark.createDataFrame([(1, 2024, 1), (2, 2024, 2)], schema), path, ["year", "month"])
    sinks.write_partitioned(spark.createDataFrame([(9, 2024, 2)], schema), path, ["year", "month"], sort=["v"])
    assert sorted((r.v, r.month) for r in spark.read.parquet(path).collect()) == [(1, 1), (9, 2)]


def test_write_date_replaces_the_whole_date(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_date(spark.createDataFrame([(1, 2024), (2, 2025)], "v int, year int"), path, "2026-10-08", ("year",))
    sinks.write_date(spark.createDataFrame([(3, 2024)], "v int, year int"), path, "2026-10-08", ("year",))
    assert [r.v for r in spark.read.parquet(path).collect()] == [3]


def test_clustered_files_are_sorted_by_key_and_time(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), (F.lit(1000) - F.col("id")).alias("t"))
    sinks.save_clustered(df, path, "k", "t", files=4)
    per_file = spark.read.parquet(path).groupBy(F.input_file_name()).agg(F.collect_list(F.struct("k", "t")).alias("x"))
    assert per_file.count() > 1
    for r in per_file.collect():
        pairs = [(x.k, x.t) for x in r.x]
        assert pairs == sorted(pairs)


def test_load_all_publishes_and_reports(spark, sf_dir, tmp_path):
    root = str(tmp_path / "db")
    frames = tables(spark, sf_dir)
    for _run in range(2):
        report = {r.table_name: r for r in load.load_all(frames, root, "run-1", AT).collect()}
    assert set(report) == set(schemas.DATASETS)
    for name, r in report.items():
        assert r.rows_staged == r.rows_loaded + r.rows_rejected == frames[name].count()
        assert spark.read.parquet(f"{root}/{name}").count() == r.rows_loaded
    assert report["rides"].rejection_reasons["NEGATIVE_DISTANCE"] > 0


def test_failed_load_leaves_old_tables(spark, sf_dir, tmp_path):
    root = str(tmp_path / "db")
    frames = tables(spark, sf_dir)
    load.load_all(frames, root)
    before = spark.read.parquet(f"{root}/customers").count()
    broken = {**frames, "payments": frames["payments"].withColumn("amount", F.raise_error(F.lit("boom")).cast("decimal(12,2)"))}
    with pytest.raises(Exception, match="boom"):
        load.load_all({**broken, "customers": frames["customers"].limit(1)}, root)
    assert spark.read.parquet(f"{root}/customers").count() == before


def test_views_and_inventory(spark, sf_dir):
    before = maintenance.table_info(spark)
    names = views.create_views(spark, tables(spark, sf_dir))
    after = maintenance.table_info(spark)
    created = {r.table_name for r in maintenance.table_changes(before, after).filter("state = 'created'").collect()}
    assert created == set(names)
    assert spark.sql("SELECT sum(total_rides) FROM v_rides_by_city").first()[0] == spark.table("v_hourly_demand").agg(F.sum("total_rides")).first()[0]


def test_pending_and_retention(spark):
    landed = spark.createDataFrame([("2026", "01"), ("2026", "01"), ("2026", "02")], "year string, month string")
    done = landed.filter("month = '01'")
    assert rows(maintenance.pending_partitions(landed, done, ["year", "month"])) == [{"year": "2026", "month": "02"}]
    parts = spark.createDataFrame([("quarantine", "rides", dt.date(2026, 1, 1)), ("quarantine", "rides", dt.date(2026, 1, 2)),
                                   ("bronze", "rides", dt.date(2025, 11, 1))], "layer string, dataset string, partition_date date")
    got = {(r.layer, str(r.partition_date)): r.action for r in maintenance.retention_candidates(parts, "2026-02-01").collect()}
    assert got == {("quarantine", "2026-01-01"): "expire", ("bronze", "2025-11-01"): "archive"}


def test_run_id():
    assert sinks.run_id("bronze", dt.datetime(2026, 8, 25, 10, 30), "0a1b2c3d") == "bronze-20260825-103000-0a1b2c3d"


def test_empty_landing(spark, raw):
    path = work_dir(spark)
    lake.land_all({n: df.limit(0) for n, df in raw.items()}, path, "2026-10-08")
    judged = lake.bronze_to_silver(spark, path, "2026-10-08", "run-1", AT, SALT)
    assert all(df.count() == 0 for df in judged.values())
    assert lake.pending_dates(spark, path) == []


def test_unknown_profile():
    with pytest.raises(ValueError):
        load.rules_for("rides", "gold")


def test_quality_report_of_empty_frame(spark):
    judged = quality.evaluate(spark.createDataFrame([], "id int"), (quality.Rule("NULL_PK", "id IS NOT NULL", "x"),))
    report = quality.quality_report(judged, "t", "id", ["id"], []).first()
    assert report.total_rows == 0 and report.rejection_rate_pct is None
