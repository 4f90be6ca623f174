"""Plan checks: what must hold for the queries to scale."""

import pytest
from pyspark.sql import functions as F

from rideflow import catalog
from rideflow.catalog import stores
from rideflow.operators import gold, quality
from rideflow.operators.dedupe import mark_first
from rideflow.plans import business, views
from rideflow.sources import sinks
from rideflow.sources.testdata import tables
from rideflow.sources.workdir import work_dir
from tests.conftest import plan

QUERIES = catalog.load().QUERIES
EAGER = ("snk_", "st_", "src_0", "sv_09", "sv_10", "dq_09", "dq_13", "flt_07", "pv_10_erase_lake")


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith(EAGER)))
def test_no_python_and_no_cross_join(name, spark, sf_dir):
    text = plan(QUERIES[name](spark, sf_dir))
    for word in ("EvalPython", "Pandas", "InArrow", "CartesianProduct"):
        assert word not in text, (name, word)
    # A nested loop join may only hold a one-row frame.
    assert "BroadcastNestedLoopJoin" not in text, name


def test_columns_are_pruned_and_filters_pushed(spark, sf_dir):
    text = plan(business.q04(tables(spark, sf_dir)))
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_totalprice:double,o_orderpriority:string>" in text
    text = plan(QUERIES["src_05_parquet_scan"](spark, sf_dir))
    assert "GreaterThan(o_totalprice,100000.0)" in text


@pytest.mark.parametrize("build", [business.q05, business.q09, views.v_driver_performance])
def test_rides_are_combined_before_the_join(build, spark, sf_dir):
    """The dimension joins one row per key, not the rides."""
    staged = stores.staged(spark, sf_dir)
    text = plan(build(staged))
    tree = text[:text.index("(1) Scan")] if "(1) Scan" in text else text
    join = tree.index("Join")
    assert "HashAggregate" in tree[join:], tree


def test_top_10_does_not_sort_everything(spark, sf_dir):
    assert "TakeOrderedAndProject" in plan(business.q05(tables(spark, sf_dir)))


def test_small_dimensions_are_broadcast_by_size_and_large_ones_are_not(spark, sf_dir):
    g = stores.gold(spark, sf_dir)
    joined = gold.star(g["fact_rides"], {"driver_key": g["dim_driver"], "date_key": g["dim_date"]})
    assert plan(joined).count("BroadcastHashJoin") >= 2
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
    try:
        joined = gold.star(g["fact_rides"], {"driver_key": g["dim_driver"]})
        assert "BroadcastHashJoin" not in plan(joined) and "SortMergeJoin" in plan(joined)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_lake_scan_reads_one_month(spark, sf_dir):
    from rideflow.plans.kpis import month_totals

    text = plan(month_totals(stores.gold(spark, sf_dir)["fact_rides"], 1997, 6))
    assert "PartitionFilters: [isnotnull(year" in text and "ReadSchema: struct<fare:decimal(10,2)>" in text


def test_results_do_not_depend_on_partitioning(spark, sf_dir):
    """The same rows in other partitions and with joins forced to shuffle give the same answers."""
    t = {n: df.repartition(5) for n, df in tables(spark, sf_dir).items()}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = [business.q05(t).collect(), business.q08(t).collect(), views.v_driver_performance(t).orderBy("vehicle_type", "city").collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    p = tables(spark, sf_dir)
    assert got == [business.q05(p).collect(), business.q08(p).collect(), views.v_driver_performance(p).orderBy("vehicle_type", "city").collect()]


def _run(spark, settings, build):
    """Run a frame under the given settings and return (rows, final plan)."""
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        df = build()
        return df.collect(), df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


# Thresholds scaled down, so that a small hot key counts as skewed.
SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
}


@pytest.mark.parametrize("unique", [True, False])
def test_hot_foreign_key_is_split(spark, unique):
    """Half of the children share one parent: their join partition is read by several tasks."""
    children = spark.range(0, 200000, 1, 8).select(
        "id", F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 5000)).alias("k"))
    parents = spark.range(0, 5000, 1, 4).select(F.concat(F.lit("k"), "id").alias("id")).union(spark.createDataFrame([("hot",)], "id string"))
    if not unique:
        parents = parents.union(parents)
    fk = quality.ForeignKey("ORPHAN", "k", parents, "id", unique)

    def build():
        return quality._check_parents(quality.evaluate(children), (fk,), work_dir(spark)).select("id", F.size("failures").alias("n"))

    rows, text = _run(spark, SKEW, build)
    assert len(rows) == 200000 and sum(r.n for r in rows) == 0
    assert "skew=true" in text


def test_hot_key_in_mark_first_stays_spread(spark):
    """No window group holds more than one input partition, though one key holds all rows."""
    df = spark.range(0, 40000, 1, 16).select(F.when(F.col("id") >= 0, "hot").alias("k"), "id")
    marked = mark_first(df, ["k"], ["id"])
    assert marked.filter("is_first").select("id").collect()[0].id == 0
    assert marked.filter("is_first").count() == 1 and marked.count() == 40000
    text = plan(marked)
    assert text.count("hashpartitioning(k") >= 2 and "_slice" in text


def test_large_partition_is_split_when_written(spark, tmp_path):
    """A month that holds all rows is written by several tasks."""
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "50000"}
    df = spark.range(0, 200000, 1, 8).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v"), F.lit(2024).alias("year"))
    _run(spark, settings, lambda: (sinks.write_partitioned(df, str(tmp_path / "t"), ["year"]), spark.range(1))[1])
    files = list((tmp_path / "t" / "year=2024").glob("*.parquet"))
    assert len(files) > 3
    assert spark.read.parquet(str(tmp_path / "t")).count() == 200000
