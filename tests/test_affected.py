"""A backfill judges the affected rows again where they are: only keys, and rows of repeated keys, are exchanged."""

import pytest
from pyspark.sql import functions as F

from rideflow import schemas
from rideflow.operators import quality
from rideflow.operators.dedupe import flag_listed, mark_first
from rideflow.plans import lake
from rideflow.sources.readers import read_bronze
from rideflow.sources.sinks import bronze_path, write_dates
from rideflow.sources.testdata import as_text, tables
from rideflow.sources.workdir import materialize, work_dir
from tests.conftest import plan

AT, DAY = "2026-10-08 12:00:00", "2026-10-08"
UNIQUE = quality.Unique("DUP", ("id",), ("id",), "d")


def test_rows_of_several_dates_are_not_shuffled_and_judged_as_one_date_after_the_other(spark):
    days = F.element_at(F.array(*[F.lit(f"2024-01-0{d}") for d in (1, 2, 3)]), (F.col("n") % 3 + 1).cast("int")).alias("_date")
    rows = spark.range(3000).withColumnRenamed("id", "n").select(
        F.when(F.col("n") % 40 != 0, F.concat(F.lit("K"), F.col("n") % 2500)).alias("id"), F.when(F.col("n") % 50 != 0, F.concat(F.lit("C"), F.col("n") % 70)).alias("k"),
        (F.col("n") % 11).alias("v"), days)
    parents = spark.range(0, 140, 2).select(F.concat(F.lit("C"), "id").alias("k"), F.when(F.col("id") % 3 == 0, "2024-01-02").otherwise("2023-12-31").alias("since"))
    loaded = spark.createDataFrame([("K7", "2023-12-30"), ("K11", "2024-01-09"), ("K2499", "2024-01-01")], "id string, _date string")
    rule, fk = quality.Rule("V", "v > 0", "v"), quality.ForeignKey("ORPHAN", "k", parents, "k", since="since")
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        judged = quality.evaluate_over_dates(rows, (rule,), (fk,), UNIQUE, loaded, work_dir(spark))
        assert "hashpartitioning" not in plan(judged)
        got = sorted((str(r.id), str(r.k), r.v, r._date, [f.code for f in r.failures]) for r in judged.collect())
    finally:
        spark.conf.set(limit, before)
    held, want = {"K7": "2023-12-30", "K11": "2024-01-09", "K2499": "2024-01-01"}, []
    for day in ("2024-01-01", "2024-01-02", "2024-01-03"):
        known = {r.k for r in parents.filter(F.col("since") <= day).collect()}
        first = set()
        for r in sorted(rows.filter(F.col("_date") == day).collect(), key=lambda r: (r.id or "", r.k or "", r.v)):
            why = ["V"] * (r.v == 0) + (["NULL_REQUIRED"] if r.k is None else ["ORPHAN"] * (r.k not in known))
            if r.id is None:
                why = why or ["NULL_REQUIRED"]
            elif held.get(r.id, day) < day:
                why = why + ["DUPLICATE_PK"]
            elif not why and r.id in first:
                why = ["DUP"]
            elif not why:
                first.add(r.id)
            want.append((str(r.id), str(r.k), r.v, r._date, why))
        held |= {i: min(held.get(i, day), day) for i in first}
    assert got == sorted(want)


def test_ineligible_rows_do_not_meet(spark):
    rows = spark.createDataFrame([("a", 2, True), ("a", 1, False), ("a", 3, True), ("b", 5, None), (None, 1, True)], "k string, v int, e boolean")
    once, twice = (mark_first(rows, ["k"], ["v"], eligible=F.col("e"), copies=n) for n in (3, None))
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))
    assert plan(once).count("Exchange (") < plan(twice).count("Exchange (")


def test_listed_keys_are_flagged_whether_the_rows_hold_them_or_not(spark):
    rows = spark.range(3000).select(F.concat(F.lit("R"), "id").alias("k"), "id").unionByName(spark.sql("SELECT CAST(NULL AS STRING) AS k, -1L AS id"))
    listed = materialize(spark.range(1000, 5000).select(F.concat(F.lit("R"), "id").alias("_key")), work_dir(spark))
    for few in (10, 100_000):
        flagged = flag_listed(rows, "k", listed, work_dir(spark), few=few)
        assert flagged.count() == 3001 and flagged.filter(F.col("_listed") != (F.col("id") >= 1000)).isEmpty()


def test_recorded_keys_are_those_of_the_json(spark):
    records = ['{"id":"R1-1","x":"a"}', '{"id":"","x":null}', '{"id":"a\\"b\\\\c","x":"y"}', '{"id":null,"x":"id"}', '{"x":"1","id":"late"}', '{"id":"\\u00e9t\u00e9"}']
    df = spark.createDataFrame([(r,) for r in records], "raw_record string")
    both = df.select(quality.recorded_key("id").alias("a"), F.get_json_object("raw_record", "$.id").alias("b")).collect()
    assert [r.a for r in both] == [r.b for r in both]


def test_dates_are_replaced_from_their_own_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    write_dates(spark.range(1000).select("id", F.concat(F.lit("d"), F.col("id") % 3).alias("ingest_date")), path, ["d0", "d1", "d2"])
    for dates in (["d0"], ["d1", "d2"]):
        held = spark.read.parquet(path).filter(F.col("ingest_date").isin(dates))
        write_dates(held.filter("id % 2 = 0"), path, dates)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == list(range(0, 1000, 2))


@pytest.fixture
def processed(spark, sf_dir):
    root = work_dir(spark)
    raw = {name: as_text(df) for name, df in tables(spark, sf_dir).items()}
    lake.land_all(raw, root, DAY)
    lake.bronze_to_silver(spark, root, DAY, "run-1", AT, "s")
    return root, raw


def _files(spark, root, layer, dataset):
    return {r.path for r in spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "part-*").load(f"{root}/{layer}/{dataset}").select("path").collect()}


def test_corrected_payments_leave_the_other_datasets_alone(spark, processed):
    root, raw = processed
    more = raw["drivers"].limit(1).withColumn("driver_id", F.lit("D99999")).withColumn("license_number", F.lit("late"))
    before = {name: _files(spark, root, "silver", name) for name in schemas.DATASETS}
    fixed = raw["payments"].filter("amount = '-1.00'").withColumn("amount", F.lit("1.00"))
    wrong, kept = fixed.count(), lake.read_silver(spark, root, "payments").count()
    judged = lake.reprocess(spark, root, "payments", fixed, DAY, "run-2", AT, "s")
    assert wrong and set(judged) == {"payments"} and lake.pending_dates(spark, root) == []
    after = {name: _files(spark, root, "silver", name) for name in schemas.DATASETS}
    assert [name for name in after if after[name] != before[name]] == ["payments"]
    assert lake.read_silver(spark, root, "payments").count() > kept
    landed = read_bronze(spark, root, "payments", schemas.PAYMENTS)
    assert landed.count() == raw["payments"].count() and landed.filter("amount = '-1.00'").isEmpty()
    # a file that came besides is processed, and what refers to its dataset
    more.write.mode("append").option("header", True).csv(bronze_path(root, "drivers", DAY))
    judged = lake.reprocess(spark, root, "payments", fixed, DAY, "run-3", AT, "s")
    assert set(judged) == {"drivers", "rides", "payments"} and lake.pending_dates(spark, root) == []
    assert not lake.read_silver(spark, root, "drivers").filter("driver_id = 'D99999'").isEmpty()


def test_erasure_stores_nothing_aside(spark, processed, monkeypatch):
    root, raw = processed
    stored = []
    monkeypatch.setattr(lake, "materialize", lambda df, path, *rest: (stored.append(df.columns), materialize(df, path, *rest))[1])
    monkeypatch.setattr(lake, "silver_to_gold", lambda *_: None)
    who = raw["customers"].filter("customer_id LIKE '%7'").select("customer_id")
    assert lake.erase_subjects(spark, root, who) == {name: [DAY] for name in ("customers", "rides", "payments")}
    assert all(len(columns) < 5 for columns in stored)
    for name in ("customers", "rides", "payments"):
        left = raw[name].join(who, "customer_id", "left_anti").count()
        assert read_bronze(spark, root, name, schemas.DATASETS[name]).count() == left
        assert lake.read_silver(spark, root, name).join(who, "customer_id", "left_semi").isEmpty()
