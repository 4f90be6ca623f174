import datetime as dt
from collections import Counter
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from rideflow.operators import history, privacy, ranking, reconcile, stats
from rideflow.operators.dedupe import first_per_key, latest_per_key, mark_first
from tests.conftest import plan, rows

# --- deduplication -------------------------------------------------------------------------------


def skewed(spark, n=4000):
    """Half of the rows share one key, a quarter are identical copies of one row."""
    return spark.range(n, numPartitions=7).select(
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))).alias("k"),
        F.when(F.col("id") % 4 == 0, F.lit(-1)).otherwise(F.col("id") % 13).cast("long").alias("v"))


def test_mark_first_flags_exactly_one_row_per_key_under_skew_and_copies(spark):
    df = skewed(spark).repartition(9)
    marked = mark_first(df, ["k"], ["v"]).collect()
    assert Counter((r.k, r.v) for r in marked) == Counter((r.k, r.v) for r in df.collect())
    winners = [r for r in marked if r.is_first]
    best = {}
    for r in df.collect():
        best[r.k] = min(best.get(r.k, r.v), r.v)
    assert {r.k: r.v for r in winners} == best and len(winners) == len(best)


def test_mark_first_respects_eligibility_and_null_keys(spark):
    df = spark.createDataFrame([("a", 1, False), ("a", 2, True), ("a", 3, True), (None, 1, True)], "k string, v int, ok boolean")
    got = {(r.k, r.v): r.is_first for r in mark_first(df, ["k"], ["v"], eligible=F.col("ok")).collect()}
    assert got == {("a", 1): False, ("a", 2): True, ("a", 3): False, (None, 1): False}


def test_first_and_latest_per_key(spark):
    df = skewed(spark)
    first = {r.k: r.v for r in first_per_key(df, ["k"], ["v"]).collect()}
    last = {r.k: r.v for r in latest_per_key(df, ["k"], ["v"]).collect()}
    values = {}
    for r in df.collect():
        values.setdefault(r.k, []).append(r.v)
    assert first == {k: min(v) for k, v in values.items()}
    assert last == {k: max(v) for k, v in values.items()}


def test_first_per_key_combines_before_the_shuffle(spark):
    text = plan(first_per_key(skewed(spark), ["k"], ["v"]))
    assert "partial_min" in text and "Window" not in text


def test_dedupe_of_empty_frame(spark):
    empty = spark.createDataFrame([], "k string, v int")
    assert first_per_key(empty, ["k"], ["v"]).count() == 0
    assert mark_first(empty, ["k"], ["v"]).count() == 0


# --- ranking and statistics ----------------------------------------------------------------------


@pytest.mark.parametrize("dense", [False, True])
def test_ranked_equals_window_rank(spark, dense):
    from pyspark.sql import Window as W

    df = spark.createDataFrame([("a", 5), ("a", 5), ("a", 3), ("a", None), ("b", 1), ("b", 7)], "g string, m long")
    window = W.partitionBy("g").orderBy(F.desc_nulls_last("m"))
    want = df.withColumn("rank", (F.dense_rank() if dense else F.rank()).over(window).cast("long"))
    got = ranking.ranked(df, "m", ["g"], dense=dense)
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))


def test_rolling_mean_fills_missing_days(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 9),), (dt.datetime(2024, 1, 1, 10),), (dt.datetime(2024, 1, 4, 1),)], "t timestamp_ntz")
    got = rows(ranking.rolling_mean(ranking.daily_counts(df, "t"), "day", "rides"), "day")
    assert [(r["rides"], r["rolling_avg"]) for r in got] == [(2, None), (0, D("2.00")), (0, D("1.00")), (1, D("0.67"))]


def test_median_by(spark):
    values = [("a", "1.00"), ("a", "2.00"), ("a", "10.01"), ("b", "1.00"), ("b", "1.01"), ("c", None)]
    df = spark.createDataFrame([(g, D(v) if v else None) for g, v in values], "g string, v decimal(10,2)")
    assert {r.g: r.median for r in stats.median_by(df, ["g"], "v").collect()} == {"a": D("2.00"), "b": D("1.01")}


def test_median_equals_brute_force(spark):
    import statistics

    data = {g: [D((i * i * 7919 + g) % 997) / 100 for i in range(1, 2 + 3 * g)] for g in range(1, 12)}
    df = spark.createDataFrame([(g, v) for g, vs in data.items() for v in vs], "g int, v decimal(10,2)")
    want = {g: statistics.median(vs).quantize(D("0.01"), rounding="ROUND_HALF_UP") for g, vs in data.items()}
    assert {r.g: r.median for r in stats.median_by(df, ["g"], "v").collect()} == want


def test_share_of_total(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "g string, n long")
    assert {r.g: r.pct for r in ranking.share_of_total(df, "n", "pct").collect()} == {"a": D("33.3"), "b": D("66.7")}


def test_growth(spark):
    df = spark.createDataFrame([(1, 100), (2, 150), (3, 75)], "m int, n long")
    assert [r["growth_pct"] for r in rows(ranking.growth(df, "m", "n"), "m")] == [None, D("50.0"), D("-50.0")]


# --- history -------------------------------------------------------------------------------------


def test_scd2_intervals(spark):
    d = dt.date
    df = spark.createDataFrame([
        ("x", d(2024, 1, 1), "Pune"), ("x", d(2024, 1, 2), "Pune"), ("x", d(2024, 1, 5), "Delhi"), ("x", d(2024, 1, 9), "Pune"),
        ("x", d(2024, 1, 9), "Pune"), ("y", d(2024, 1, 3), None), ("y", d(2024, 1, 4), None)], "id string, day date, city string")
    got = [tuple(r.values()) for r in rows(history.scd2(df, "id", ["city"], "day"), "id", "valid_from")]
    assert got == [
        ("x", "Pune", d(2024, 1, 1), d(2024, 1, 5), False), ("x", "Delhi", d(2024, 1, 5), d(2024, 1, 9), False),
        ("x", "Pune", d(2024, 1, 9), None, True), ("y", None, d(2024, 1, 3), None, True)]


def test_upsert_is_idempotent(spark):
    current = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "id int, v string, ver int")
    changes = spark.createDataFrame([(2, "B", 2), (3, "c", 1), (1, "old", 0)], "id int, v string, ver int")
    once = history.upsert(current, changes, "id", "ver")
    twice = history.upsert(once, changes, "id", "ver")
    assert rows(once, "id") == rows(twice, "id") == [
        {"id": 1, "v": "a", "ver": 1}, {"id": 2, "v": "B", "ver": 2}, {"id": 3, "v": "c", "ver": 1}]


def test_upsert_change_wins_at_equal_order(spark):
    schema = "id int, v string, ver int"
    got = history.upsert(spark.createDataFrame([(1, "z", 1)], schema), spark.createDataFrame([(1, "a", 1)], schema), "id", "ver")
    assert got.first().v == "a"


# --- reconciliation and privacy ------------------------------------------------------------------


def test_reconcile_payments(spark):
    rides = spark.createDataFrame([("r1", D("10.00"), "completed"), ("r2", D("10.00"), "completed"), ("r3", D("10.00"), "cancelled"),
                                   ("r4", D("10.00"), "completed")], "ride_id string, fare decimal(10,2), ride_status string")
    pays = spark.createDataFrame([("r1", D("10.00"), "completed"), ("r4", D("4.00"), "completed"), ("r4", D("4.00"), "completed"),
                                  ("r9", D("1.00"), "failed")], "ride_id string, amount decimal(10,2), payment_status string")
    got = {r.ride_id: r.finding for r in reconcile.reconcile_payments(rides, pays).collect()}
    assert got == {"r1": "ok", "r2": "missing_payment", "r3": "ok", "r4": "amount_mismatch", "r9": "missing_ride"}


def test_orphans_ignore_null_keys(spark):
    child = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    parent = spark.createDataFrame([("a",), (None,)], "id string")
    assert [r.k for r in reconcile.orphans(child, "k", parent, "id").collect()] == ["b"]
    assert rows(reconcile.orphan_keys(child, "k", parent, "id")) == [{"k": "b", "rows": 1}]


def test_erase_and_access(spark):
    t = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "customer_id string, v int")
    who = spark.createDataFrame([("a",), (None,)], "customer_id string")
    assert sorted(r.v for r in privacy.erase(t, who, "customer_id").collect()) == [2, 3]
    assert [r.v for r in privacy.subject_access({"t": t}, who, "customer_id")["t"].collect()] == [1]


def test_k_anonymity(spark):
    df = spark.createDataFrame([("p", 1), ("p", 1), ("q", 1)], "city string, x int")
    assert rows(privacy.k_anonymity(df, ["city", "x"], 2)) == [{"city": "q", "x": 1, "group_size": 1}]


def test_pii_scan_finds_each_kind(spark):
    df = spark.createDataFrame([("mail a.b@c.org",), ("call +91 9876543210",), ("pay 4111-1111-1111-1111 now",), ("nothing 12",)], "note string")
    assert {r.pattern: r.hits for r in privacy.pii_scan(df).collect()} == {"email": 1, "phone": 1, "card": 1}


def test_roles(spark):
    t, v = {"rides": spark.range(1)}, {"v": spark.range(1)}
    assert set(privacy.visible_frames("bi_reader", t, v)) == {"v"}
    assert set(privacy.visible_frames("data_analyst", t, v)) == {"rides", "v"}
    with pytest.raises(ValueError):
        privacy.visible_frames("guest", t, v)


def test_profile_and_drift(spark):
    df = spark.createDataFrame([("a", D("-1.00"), 1), ("a", D("0.00"), 1), ("b", D("4.00"), 2)], "c string, m decimal(10,2), p int")
    got = {(r.column_name, r.statistic): r.value for r in stats.profile(df, ["c"], ["m"]).collect()}
    assert got[("c", "a")] == 2 and got[("m", "mean")] == D("1.00") and got[("m", "negative")] == 1 and got[("m", "zero")] == 1
    moves = {(r.period, r.category): (r.share_pct, r.change_pct) for r in stats.drift(
        df.union(df.filter("c = 'a'").withColumn("p", F.lit(2))), "c", "p").collect()}
    assert moves[(2, "a")] == (D("66.67"), D("-33.33"))
