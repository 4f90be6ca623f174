"""Every registered query against DuckDB on the smallest data."""

import pytest

import __spark_entry__ as entry
from rideflow import catalog
from tests.compare import compare

QUERIES = catalog.load().QUERIES
ORACLE = catalog.load().ORACLE


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(name, spark, con, sf_dir):
    _kind, _rows, problems = compare(spark, con, name, QUERIES[name], ORACLE.get(name), sf_dir)
    assert not problems, problems


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["payment_method", "total_txns", "total_revenue", "avg_amount", "total_tips", "pct_of_total"]
    assert df.count() == 5
