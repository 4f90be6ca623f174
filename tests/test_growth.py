"""What must not grow faster than the input: exchanges of whole rows, landed bytes, work that a query does not ask for."""

from pyspark.sql import functions as F

from rideflow import catalog, schemas
from rideflow.catalog import stores
from rideflow.operators import gold, quality
from rideflow.operators.dedupe import flag_exactly, flag_members, mark_first
from rideflow.operators.history import as_of
from rideflow.sources import bucketed
from rideflow.sources.sinks import land_bronze, write_date
from rideflow.sources.workdir import materialize, work_dir
from tests.conftest import plan


def test_members_are_flagged_without_a_shuffle(spark):
    rows = spark.range(2000).select(F.concat(F.lit("R"), "id").alias("k"), "id").unionByName(spark.sql("SELECT CAST(NULL AS STRING) AS k, -1L AS id"))
    keys = materialize(rows.filter("id % 10 = 3").select("k"), work_dir(spark))
    for most in (1 << 28, 1 << 16):
        flagged = flag_members(rows, keys, ["k"], 200, work_dir(spark), most_bits=most)
        assert "hashpartitioning" not in plan(flagged)
        got = {r.id: r["_listed"] for r in flagged.collect()}
        assert len(got) == 2001 and all(got[i] for i in range(3, 2000, 10)) and not got[-1]
        assert sum(got.values()) < 500


def test_rows_of_a_key_meet_once_where_no_key_is_hot(spark):
    rows = spark.createDataFrame([("a", 2), ("a", 1), ("b", 5), (None, 1), (None, 0)], "k string, v int")
    once, twice = mark_first(rows, ["k"], ["v"], copies=2), mark_first(rows, ["k"], ["v"])
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))
    assert plan(once).count("Exchange (") < plan(twice).count("Exchange (")


def test_accepted_rows_are_not_shuffled_however_many_keys_repeat(spark):
    ids = spark.range(3000).select(F.concat(F.lit("P"), F.col("id") % 2000).alias("payment_id"), "id")
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        judged = quality.judge(ids, (), (), quality.unique_rules("payments"), stage_in=work_dir(spark))
        good = quality.accepted(judged)
        assert "hashpartitioning" not in plan(good)
        assert good.count() == 2000 and quality.rejected(judged).count() == 1000
        assert good.agg(F.max("id")).first()[0] == 1999
    finally:
        spark.conf.set(limit, before)


def test_keys_are_told_apart_exactly_without_a_shuffle(spark):
    rows = spark.range(6000).select(F.concat(F.lit("R"), "id").alias("k"), "id").unionByName(spark.sql("SELECT CAST(NULL AS STRING) AS k, -1L AS id"))
    for listed in ("id % 2 = 0", "id % 10 = 3", "id % 10 <> 3", "id < 0", "id >= 0"):
        keys = materialize(rows.filter("id >= 0").select(F.col("k").alias("_key"), F.expr(listed).alias("_in")), work_dir(spark))
        for few, most, turns in ((10_000, 1 << 28, 8), (10, 1 << 28, 8), (10, 1 << 15, 8), (10, 1 << 15, 1)):
            flagged = flag_exactly(rows, "k", keys, work_dir(spark), few=few, most_bits=most, turns=turns)
            assert turns == 1 or "hashpartitioning" not in plan(flagged)
            wrong = flagged.filter(F.col("_listed") != (F.expr(listed) & F.col("k").isNotNull()))
            assert flagged.count() == 6001 and wrong.isEmpty() and flagged.filter("_listed IS NULL").isEmpty()


def test_rows_stay_where_they_are_however_many_parents_there_are(spark):
    ids = F.concat(F.lit("C"), F.col("id") % 700).alias("k")
    rows = spark.range(3000).select("id", F.when(F.col("id") % 50 != 0, ids).alias("k"), (F.col("id") % 11).alias("v"))
    parents = spark.range(0, 1400, 2).select(F.concat(F.lit("C"), "id").alias("k"))
    parents = parents.unionByName(parents)
    args = (rows, (quality.Rule("V", "v > 0", "v"),), (quality.ForeignKey("ORPHAN", "k", parents, "k"),), (quality.Unique("DUP", ("id",), ("id",), "d"),))
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        judged = quality.judge(*args, stage_in=work_dir(spark))
        assert "hashpartitioning" not in plan(judged)
    finally:
        spark.conf.set(limit, before)
    got, expected = ({r.id: [f.code for f in r.failures] for r in df.collect()} for df in (judged, quality.evaluate(*args)))
    assert got == expected and len(got) == 3000 and {"V", "ORPHAN"} == set(got[11])


def test_judged_queries_read_the_tables_once(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(stores, "_built", {})
    reasons = catalog.load().QUERIES["dq_05_legacy_reasons"](spark, sf_dir)
    assert "lineitem" not in plan(reasons) and "orders.parquet" not in plan(reasons)
    assert not any(kind == "staged" for _app, _dir, kind in stores._built)


def test_versions_that_never_change_need_no_join(spark):
    days = spark.sql("SELECT * FROM VALUES (1L, DATE '2024-01-01'), (2L, DATE '2024-01-01'), (3L, DATE '2024-01-01'), (3L, DATE '2024-03-01'), (4L, DATE '2024-02-01') AS t(driver_key, valid_from)")
    versions = days.select(gold.surrogate_key("driver_key", "valid_from").alias("driver_version"), "*")
    at = F.explode(F.array(*[F.lit(f"{d} 10:00:00").cast("timestamp_ntz") for d in ("2023-01-01", "2024-02-10", "2024-03-01")])).alias("at")
    fact = spark.sql("SELECT * FROM VALUES (1L), (2L), (3L), (4L), (5L), (NULL) AS t(driver_key)").select("driver_key", at)
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        for some in (fact, fact.filter("driver_key < 3 OR driver_key IS NULL"), fact.limit(0)):
            expected = as_of(some, versions, "driver_key", "at", "valid_from", ["driver_version"], open_start=True)
            assert sorted(map(str, gold.with_version(some, versions, "driver", "at").collect())) == sorted(map(str, expected.collect()))
        assert "Join" not in plan(gold.with_version(fact.filter("driver_key < 3"), versions, "driver", "at"))
        assert [r.driver_version for r in gold.with_version(fact, versions.limit(0), "driver", "at").collect()] == [None] * 18
    finally:
        spark.conf.set(limit, before)


def test_versions_of_few_days_need_no_shuffle_of_facts(spark, monkeypatch):
    span = "SELECT id AS driver_key, explode(sequence(DATE '2024-01-01', date_add(DATE '2024-01-01', CAST(id % 4 AS INT) * 10), INTERVAL 10 DAYS)) AS valid_from FROM range(400)"
    days = spark.sql(span).filter("(driver_key + day(valid_from)) % 7 > 0")
    versions = materialize(days.select(gold.surrogate_key("driver_key", "valid_from").alias("driver_version"), "*"), work_dir(spark))
    at = F.timestamp_add("HOUR", (F.col("id") * 7 % 1200).cast("int"), F.lit("2023-12-25 00:00:00").cast("timestamp_ntz"))
    fact = spark.range(3000).select("id", F.when(F.col("id") % 50 > 0, F.col("id") % 450).alias("driver_key"), F.when(F.col("id") % 60 > 0, at).alias("at"))
    want = sorted(map(str, as_of(fact, versions, "driver_key", "at", "valid_from", ["driver_version"], open_start=True).collect()))
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        got = gold.with_version(fact, versions, "driver", "at")
        assert "hashpartitioning" not in plan(got) and "SortMergeJoin" not in plan(got)
        assert sorted(map(str, got.collect())) == want
        monkeypatch.setattr(gold, "FEW_DAYS", 3)  # a longer history
        assert sorted(map(str, gold.with_version(fact.filter("at IS NOT NULL"), versions, "driver", "at").collect())) == [r for r in want if "at=None" not in r]
    finally:
        spark.conf.set(limit, before)


def test_buckets_grow_in_number(spark):
    facts = spark.range(1000).select((F.col("id") % 90).alias("k"), "id", F.lit(1).alias("t"))
    names = ("growth_dealt", "growth_copied")
    bucketed.save_for_join(facts, facts.filter("id < 90"), names, work_dir(spark), "k", ("t", "t"), buckets=2, bucket_rows=100)
    try:
        joined = bucketed.join_stored(spark, names, "k")
        assert joined.count() == 1000 and joined.rdd.getNumPartitions() == 10
        assert "Exchange" not in plan(joined)
    finally:
        for name in names:
            spark.sql(f"DROP TABLE {name}")


def test_landed_files_are_packed_and_a_date_is_written_in_place(spark, tmp_path):
    rows = spark.range(1000, numPartitions=3).select(F.col("id").cast("string").alias("a"), F.lit("x" * 50).alias("b"))
    path = land_bronze(rows, str(tmp_path), "payments", "2026-10-08")
    files = [r.path for r in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path").collect()]
    assert files and all(f.endswith(".csv.gz") for f in files)
    write_date(rows, str(tmp_path / "s"), "2026-10-08")
    assert spark.read.parquet(str(tmp_path / "s")).count() == 1000
    assert len(list((tmp_path / "s").rglob("*.parquet"))) == 3


def test_silver_of_a_dataset_builds_only_what_it_refers_to(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(stores, "_built", {})
    landed = []
    land = stores.lake.land_all
    monkeypatch.setattr(stores.lake, "land_all", lambda raw, *rest: (landed.extend(raw), land(raw, *rest))[1])
    assert stores.silver(spark, sf_dir)["drivers"].count() > 0
    assert landed == ["drivers"]
    assert set(stores.silver(spark, sf_dir)) == set(schemas.DATASETS)
