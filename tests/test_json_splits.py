"""JSON arrays read in splits give what a reader of whole files gives."""

import json
import random

import pytest
from pyspark.sql import types as T

from rideflow.sources import readers, sinks

SCHEMA = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.LongType()), T.StructField("c", T.StringType())])
BITS = ["}", "{", '"', "\\", "\n", "[", "]", ",", "é", "\U0001F600", "x", " ", "},{", '\\"', '"}', "\\}"]


def records(seed, n, longest=12):
    rng = random.Random(seed)
    return [{"a": "".join(rng.choices(BITS, k=rng.randrange(longest))), "b": rng.choice([None, i]), "c": rng.choice(["", "plain", "}" * 5])} for i in range(n)]


@pytest.mark.parametrize("block", ["64", "1000", "100000"])
def test_arrays_in_splits(spark, tmp_path, block):
    made = {"one.json": records(1, 400), "two.json": records(2, 50, 3000), "three.json": records(3, 1), "none.json": []}
    for i, (name, rows) in enumerate(made.items()):
        (tmp_path / name).write_text(json.dumps(rows, indent=[None, 2, 0, None][i], ensure_ascii=bool(i % 2)), encoding="utf-8")
    (tmp_path / "lines.json").write_text("\n".join(json.dumps(r) for r in records(4, 30)) + "\n", encoding="utf-8")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        pieces = spark.read.option("lineSep", "}").text(str(tmp_path / "two.json"))
        assert block == "100000" or pieces.rdd.getNumPartitions() > 8
        got = readers.read_json_splits(spark, str(tmp_path), SCHEMA).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    want = [r for rows in [*made.values(), records(4, 30)] for r in rows]
    key = lambda r: json.dumps([r["a"], r["b"], r["c"]])
    assert sorted(map(key, got)) == sorted(map(key, want))


def test_nested_objects_and_no_files_content(spark, tmp_path):
    rows = [{"a": "x", "b": i, "o": {"p": {"q": "}"}, "l": [{"z": 1}, {"z": "{"}]}, "c": "y"} for i in range(20)]
    (tmp_path / "n.json").write_text(json.dumps(rows), encoding="utf-8")
    (tmp_path / "empty.json").write_text("", encoding="utf-8")
    got = readers.read_json_splits(spark, str(tmp_path), SCHEMA).collect()
    assert sorted((r.a, r.b, r.c) for r in got) == [("x", i, "y") for i in range(20)]


def test_written_arrays_are_whole_and_read_both_ways(spark, tmp_path):
    rows = [(r["a"], r["b"], r["c"]) for r in records(5, 500, 40)] + [(None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    sinks.write_json_arrays(df, str(tmp_path / "t"))
    files = list((tmp_path / "t").glob("array=*/part-*"))
    assert len(files) == 5 and sum(len(json.loads(f.read_text(encoding="utf-8"))) for f in files) == 501
    key = lambda r: json.dumps(list(r))
    whole = readers.read_json(spark, str(tmp_path / "t" / "*"), SCHEMA).collect()
    in_splits = readers.read_json_splits(spark, str(tmp_path / "t"), SCHEMA).collect()
    assert sorted(map(key, whole)) == sorted(map(key, rows)) == sorted(map(key, in_splits))
    sinks.write_json_arrays(df.limit(0), str(tmp_path / "none"))
    assert not list((tmp_path / "none").glob("array=*"))
