"""Headline timings, one JSON line on stdout.

Tables are staged once, as a user would load them, and staging is timed too. Load, lake and queries run
once to warm up, then three times; the median counts. Queries go into a sink that consumes every row.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))


def main() -> None:
    from pyspark.sql import SparkSession

    from rideflow.catalog import stores
    from rideflow.plans import business, kpis, lake, load, views
    from rideflow.sources.testdata import as_text
    from rideflow.session import SETTINGS
    from rideflow.sources.workdir import work_dir

    builder = SparkSession.builder.master(f"local[{CPUS}]").appName("bench")
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    spark = (builder.config("spark.sql.shuffle.partitions", str(CPUS)).config("spark.driver.memory", "8g")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1).count()
    times: dict[str, float] = {}

    def timed(name, run, repeat=1):
        taken = []
        for _ in range(repeat):
            start = time.perf_counter()
            result = run()
            taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken), 3)
        return result

    def consume(df):
        df.write.format("noop").mode("overwrite").save()

    staged = timed("stage_tables", lambda: stores.staged(spark, SF_DIR))
    load.load_all(staged, work_dir(spark)).collect()
    report = timed("load_all", lambda: load.load_all(staged, work_dir(spark)).collect(), 3)
    root, date, now = stores.lake_root(spark, SF_DIR), stores.INGEST_DATE, "2026-10-08 12:00:00"
    timed("land_bronze", lambda: lake.land_all({n: as_text(df) for n, df in staged.items()}, work_dir(spark), date), 3)
    timed("bronze_to_silver", lambda: lake.bronze_to_silver(spark, root, date, "run-1", now, stores.SALT), 3)
    timed("silver_to_gold", lambda: lake.silver_to_gold(spark, root, (date, date)), 3)
    silver, gold = stores.silver(spark, SF_DIR), stores.gold(spark, SF_DIR)

    queries = {f"q{i:02d}": (getattr(business, f"q{i:02d}"), staged) for i in range(1, 11)}
    queries |= {name: (view, staged) for name, view in views.VIEWS.items()}
    queries |= {"kp_executive": (kpis.executive, silver), "kp_demand_trend": (kpis.demand_trend, silver),
                "kp_driver_ranking": (kpis.driver_ranking, silver), "kp_demand_by_cell": (kpis.demand_by_cell, silver),
                "lk_city_demand": (kpis.city_demand, gold), "lk_peak_hours": (kpis.peak_hours, gold),
                "lk_full_scan": (lambda g: kpis.month_totals(g["fact_rides"]), gold),
                "lk_pruned_scan": (lambda g: kpis.month_totals(g["fact_rides"], 1997, 6), gold)}
    for name, (plan, tables) in queries.items():
        consume(plan(tables))
        timed(name, lambda plan=plan, tables=tables: consume(plan(tables)), 3)

    staged_rows = sum(r.rows_staged for r in report)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1], "cpus": CPUS, "rows_staged": staged_rows,
        "load_rows_per_sec": round(staged_rows / times["load_all"])}))
    spark.stop()


if __name__ == "__main__":
    main()
