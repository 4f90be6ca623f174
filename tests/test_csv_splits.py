"""CSV with line breaks in quotes, read in splits, gives what was written."""

import random
from contextlib import contextmanager

import pytest
from pyspark.sql import types as T

from rideflow.sources import readers, sinks

SCHEMA = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.LongType()), T.StructField("c", T.StringType()), T.StructField("d", T.StringType())])
BITS = ["\n", "\r\n", "\r", '"', '""', ",", "\\", "é", "\U0001F600", "x", " ", '\n"', '",', "\n\n", '"\n"']


@contextmanager
def splits_of(spark, size):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def records(seed, n, longest=10):
    rng = random.Random(seed)
    text = lambda: rng.choice([None, "", "plain", "".join(rng.choices(BITS, k=rng.randrange(longest)))])
    return [(text(), rng.choice([None, i]), text(), text()) for i in range(n)]


def _bag(found):
    return sorted(map(repr, map(tuple, found)))


@pytest.mark.parametrize("size", ["64", "700", "1000000"])
@pytest.mark.parametrize("lenient", [False, True])
def test_round_trip_with_line_breaks_in_every_column(spark, tmp_path, size, lenient):
    want = records(1, 400) + records(2, 20, 2000) + [("plain", 7, "x", "y")] * 300
    sinks.write_csv(spark.createDataFrame(want, SCHEMA).coalesce(2), str(tmp_path / "t"), line_breaks=True)
    with splits_of(spark, size):
        files = len(list((tmp_path / "t").glob("part-*")))
        assert size == "1000000" or spark.read.text(str(tmp_path / "t")).rdd.getNumPartitions() > 4 * files
        got = readers.read_csv_splits(spark, str(tmp_path / "t"), SCHEMA, lenient).collect()
    whole = readers.read_raw(spark, str(tmp_path / "t"), SCHEMA, lenient, line_breaks=True).collect()
    assert _bag(got) == _bag([(a, None if b is None else str(b), c, d) for a, b, c, d in want] if lenient else want)
    assert _bag(got) == _bag(whole)


@pytest.mark.parametrize("size", ["16", "100000"])
def test_headers_blank_lines_and_empty_files(spark, tmp_path, size):
    (tmp_path / "broken_header.csv").write_bytes(b'\n\r\n"a\n1",b,"c\r\n",d\r\nx,1,y,z\r\n\r\n\n"p\r\nq",2,"",\r\n')
    (tmp_path / "no_end.csv").write_bytes(b'\xef\xbb\xbfa,b,c,d\nx,3,"\n\n",z')
    (tmp_path / "header_only.csv").write_bytes(b"a,b,c,d\n")
    (tmp_path / "empty.csv").write_bytes(b"")
    with splits_of(spark, size):
        got = readers.read_csv_splits(spark, str(tmp_path), SCHEMA).collect()
    assert _bag(got) == _bag([("x", 1, "y", "z"), ("p\r\nq", 2, "", None), ("x", 3, "\n\n", "z")])


def test_a_quote_that_stays_open_or_a_bad_value_fails(spark, tmp_path):
    (tmp_path / "open").mkdir()
    (tmp_path / "open" / "t.csv").write_text('a,b,c,d\nx,1,"y,z\nx,2,y,z\n')
    with pytest.raises(Exception, match="quotes do not pair"):
        readers.read_csv_splits(spark, str(tmp_path / "open"), SCHEMA, lenient=True).collect()
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "t.csv").write_text("a,b,c,d\nx,one,y,z\n")
    with pytest.raises(Exception):
        readers.read_csv_splits(spark, str(tmp_path / "bad"), SCHEMA).select("a").collect()
    assert readers.read_csv_splits(spark, str(tmp_path / "bad"), SCHEMA, lenient=True).first().b == "one"


def test_files_without_line_breaks_are_not_exchanged(spark, tmp_path):
    """Only the carried sums are shuffled: one row a split."""
    sinks.write_csv(spark.range(5000).selectExpr("'x' AS a", "id AS b", "'y' AS c", "'z' AS d").coalesce(1), str(tmp_path / "t"))
    with splits_of(spark, "5000"):
        found = readers.read_csv_splits(spark, str(tmp_path / "t"), SCHEMA)
        assert len(found.collect()) == 5000
    final = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in final.split("Initial Plan")[0]
