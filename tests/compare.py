"""Run registered queries on Spark and on DuckDB and compare them, columns sorted by name.

    python -m tests.compare [--sf 0.01] [name-prefix ...]
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import math
import sys
import time
from collections import Counter

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def spark_session(cores: int = 8):
    from pyspark.sql import SparkSession

    return (SparkSession.builder.master(f"local[{cores}]").appName("rideflow-checks")
            .config("spark.sql.shuffle.partitions", "8")
            .config("spark.sql.session.timeZone", "UTC")
            .config("spark.driver.memory", "8g")
            .config("spark.ui.enabled", "false")
            .config("spark.ui.showConsoleProgress", "false")
            .getOrCreate())


def duck(directory: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{directory}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return ("n", str(value.normalize() + 0))
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, int):
        return ("n", str(decimal.Decimal(value).normalize() + 0))
    if isinstance(value, float):
        return "nan" if math.isnan(value) else ("f", f"{value:.9g}")
    if isinstance(value, (dt.date, dt.datetime)):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, plain(v)) for k, v in value.items()))
    return value


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(c.lower() for c in columns), Counter(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, con, name, fn, sql, directory):
    df = fn(spark, directory)
    got_columns, got = bag(df.columns, df.collect())
    if sql is None:
        return "rows", sum(got.values()), []
    cur = con.execute(sql)
    want_columns, want = bag([d[0] for d in cur.description], cur.fetchall())
    problems = []
    if got_columns != want_columns:
        problems.append(f"columns {got_columns} != {want_columns}")
    if got != want:
        problems.append(f"rows {sum(got.values())} vs {sum(want.values())}; "
                        f"only spark {list((got - want).items())[:3]}; only duckdb {list((want - got).items())[:3]}")
    return "oracle", sum(got.values()), problems


def main(argv=None):
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args(argv)
    import __spark_entry__ as entry

    directory = f"/root/testdata/sf{args.sf}"
    spark, con = spark_session(), duck(directory)
    spark.sparkContext.setLogLevel("ERROR")
    sqls = entry.oracle_sql()
    bad = 0
    for name, fn in entry.queries().items():
        if args.names and not any(name.startswith(n) for n in args.names):
            continue
        start = time.time()
        try:
            kind, rows, problems = compare(spark, con, name, fn, sqls.get(name), directory)
        except Exception as e:  # noqa: BLE001
            kind, rows, problems = "error", 0, [f"{type(e).__name__}: {str(e)[:900]}"]
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name:38s} {kind:6s} rows={rows:<7d} {time.time() - start:6.2f}s", flush=True)
        for p in problems:
            print("     ", p[:1500], flush=True)
    print("failed:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
