"""Table layouts: merges that rewrite few files, and joins of stored facts without an exchange."""

import uuid

import pytest
from pyspark.sql import functions as F

from rideflow.sources import bucketed, merge, sinks
from rideflow.sources.workdir import work_dir
from tests.conftest import plan

SCHEMA = "k string, v int, at int"


def _table(spark, n=1000, rows_per_file=100):
    root = work_dir(spark)
    rows = spark.range(n).select(F.format_string("k%06d", "id").alias("k"), F.lit(0).alias("v"), F.lit(1).alias("at"))
    assert merge.create_table(rows, root, "k", rows_per_file) == 0
    return root


def _files(spark, root, version=None):
    return {f.file: (f.least, f.most, f.rows) for f in merge.manifest(spark, root, version).collect()}


def _content(spark, root, version=None):
    return {r.k: (r.v, r.at) for r in merge.read_table(spark, root, version).collect()}


def test_merge_rewrites_only_files_that_hold_changed_keys(spark):
    root = _table(spark)
    before, want = _files(spark, root), _content(spark, root)
    assert len(before) >= 10
    changes = [("k000150", 7, 2), ("k000151", 7, 0), ("k000152", 7, 1), ("k000150", 6, 1), ("k000149x", 8, 9), ("a", 9, 1), ("z", 9, 1)]
    assert merge.merge_into(spark.createDataFrame(changes, SCHEMA), root, "k", "at", 100) == 1
    after = _files(spark, root)
    hit = {f for f, (low, high, _) in before.items() if any(low <= k <= high for k in ("k000150",)) or low == "k000000" or high == "k000999"}
    untouched = set(before) & set(after)
    assert untouched == set(before) - hit and len(untouched) >= len(before) - 3
    want |= {"k000150": (7, 2), "k000152": (7, 1), "k000149x": (8, 9), "a": (9, 1), "z": (9, 1)}
    assert _content(spark, root) == want
    ranges = sorted(after.values())
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:])) and sum(r[2] for r in ranges) == len(want)
    assert max(r[2] for r in ranges) <= 100


def test_readers_see_whole_versions(spark):
    root = _table(spark, 300)
    old = _content(spark, root)
    change = spark.createDataFrame([("k000001", 1, 5)], SCHEMA)
    broken = change.withColumn("v", F.raise_error(F.lit("boom")).cast("int"))
    with pytest.raises(Exception, match="boom"):
        merge.merge_into(broken, root, "k", "at", 100)
    assert merge.versions(spark, root) == [0] and _content(spark, root) == old
    merge.merge_into(change, root, "k", "at", 100)
    assert _content(spark, root, 0) == old and _content(spark, root) == old | {"k000001": (1, 5)}
    # a merge that comes second with the same number fails and changes nothing
    with pytest.raises(Exception, match="(?i)exist"):
        merge._publish(spark, root, "k", 1, merge.manifest(spark, root).first().file.rsplit("/", 2)[0], [])
    merge.merge_into(change.withColumn("at", F.lit(6)), root, "k", "at", 100)
    now = _content(spark, root)
    assert merge.forget(spark, root, keep=1) and _content(spark, root) == now and merge.versions(spark, root) == [2]
    with pytest.raises(ValueError):
        merge.read_table(spark, root, 0)


def test_merge_small_cases(spark):
    root = _table(spark, 10)
    assert merge.merge_into(spark.createDataFrame([], SCHEMA), root, "k", "at") == 0
    with pytest.raises(Exception, match="without k"):
        merge.merge_into(spark.createDataFrame([(None, 1, 1)], SCHEMA), root, "k", "at")
    with pytest.raises(ValueError):
        merge.create_table(spark.createDataFrame([], SCHEMA), root, "k")
    many = work_dir(spark)
    merge.create_table(spark.range(500).select("id", F.lit(0).alias("at")), many, "id", 7)
    merge.merge_into(spark.range(0, 600, 3).select("id", F.lit(1).alias("at")), many, "id", "at", 7)
    got = merge.read_table(spark, many)
    assert got.count() == 500 + 33 and got.where("at = 1").count() == 200 and got.select("id").distinct().count() == 533


@pytest.fixture(scope="module")
def facts(spark):
    left = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 97 == 0, None).otherwise(F.col("id") % 50).alias("k"),
                                      F.col("id").alias("a"), (F.lit(0) - F.col("id")).alias("t"))
    right = spark.range(120).select(F.when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 40).alias("k"), F.col("id").alias("b"), F.col("id").alias("u"))
    names = tuple(f"{n}_{uuid.uuid4().hex}" for n in "lr")
    hot = bucketed.save_for_join(left, right, names, work_dir(spark), "k", ("t", "u"), buckets=8)
    return left, right, names, hot


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_stored_facts_join_without_an_exchange(spark, facts, how):
    left, right, names, _ = facts
    joined = bucketed.join_stored(spark, names, "k", how)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(joined)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Exchange" not in text and "SortMergeJoin" in text
    want = left.join(right, "k", how).select(*joined.columns)
    assert sorted(map(str, joined.collect())) == sorted(map(str, want.collect()))


def test_a_hot_key_lies_in_several_buckets(spark, facts):
    left, right, names, hot = facts
    assert set(hot) == {1} and hot[1] >= 3
    stored = spark.table(names[0])
    total = left.count()
    largest = max(r[1] for r in stored.groupBy(F.regexp_extract("_metadata.file_path", r"_(\d{5})\.", 1)).count().collect())
    assert stored.groupBy("k").count().where("k = 1").first()["count"] > total / 3 > largest
    assert sorted(map(str, bucketed.dealt_rows(spark, names[0]).collect())) == sorted(map(str, left.collect()))
    assert sorted(map(str, bucketed.copied_rows(spark, names[1], "k").collect())) == sorted(map(str, right.collect()))
    assert spark.table(names[1]).where("k = 1").count() == hot[1] * right.where("k = 1").count()


def test_files_are_sorted_by_key_and_time(spark, facts):
    rows = spark.table(facts[2][0]).select(F.input_file_name().alias("f"), F.monotonically_increasing_id().alias("i"), "k", "_salt", "t").orderBy("f", "i").collect()
    by_file = {}
    for r in rows:
        by_file.setdefault(r.f, []).append((r.k is not None, r.k or 0, r._salt, r.t))
    assert len(by_file) == 8 and all(v == sorted(v) for v in by_file.values())


def test_outer_joins_of_copies_are_refused(spark, facts):
    with pytest.raises(ValueError):
        bucketed.join_stored(spark, facts[2], "k", "full_outer")


def _sizes(root):
    return {str(p): p.stat().st_size for p in root.rglob("*.parquet")}


def test_compaction_joins_neighbouring_small_files(spark, tmp_path):
    root = str(tmp_path / "t")
    rows = spark.range(40_000).select(F.format_string("k%06d", "id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"), F.lit(1).alias("at"))
    merge.create_table(rows.where("k < 'k020000'"), root, "k", 1000)
    big = rows.where("k >= 'k020000'")
    merge.merge_into(big, root, "k", "at", 20_000)
    before = {f.file: f for f in merge.manifest(spark, root).collect()}
    size = {n: (tmp_path / "t" / n).stat().st_size for n in before}
    target = 400_000
    small = {n for n in before if 2 * size[n] <= target}
    assert len(small) > 5 and set(before) - small
    held = sorted(map(str, merge.read_table(spark, root).collect()))
    version = merge.compact(spark, root, "k", target)
    after = {f.file: f for f in merge.manifest(spark, root).collect()}
    assert version == 2 and len(after) < len(before) / 2
    assert set(before) - small <= set(after)  # large files are not read
    assert all((tmp_path / "t" / n).stat().st_size <= 1.2 * target for n in set(after) - set(before))
    assert sorted(map(str, merge.read_table(spark, root).collect())) == held == sorted(map(str, merge.read_table(spark, root, 1).collect()))
    ranges = sorted((f.least, f.most) for f in after.values())
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
    # a merge goes on from the new files; nothing is left to join
    while (again := merge.compact(spark, root, "k", target)) != version:
        version = again
    merge.merge_into(rows.limit(1).withColumn("at", F.lit(2)), root, "k", "at", 20_000)
    assert merge.read_table(spark, root).where("at = 2").count() == 1 and merge.read_table(spark, root).count() == 40_000


def test_many_small_files_are_read_as_folders_and_written_by_many_tasks(spark, tmp_path):
    root = str(tmp_path / "t")
    rows = spark.range(600).select(F.format_string("k%05d", "id").alias("k"), F.lit(0).alias("at"))
    merge.create_table(rows, root, "k", 5)
    assert len({f.file.split("/")[-1].split("-")[1] for f in merge.manifest(spark, root).collect()}) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    merge.merge_into(rows.where("k BETWEEN 'k00300' AND 'k00302'").withColumn("at", F.lit(1)), root, "k", "at", 5)
    versions = []
    # a folder that holds files of another version or of no version is not read as a whole
    for version in (0, 1):
        paths = []
        read = type(spark.read).parquet
        type(spark.read).parquet = lambda self, *p, **k: (paths.extend(p), read(self, *p, **k))[1]
        try:
            versions.append((merge.read_table(spark, root, version), len(paths)))
        finally:
            type(spark.read).parquet = read
    assert versions[0][1] <= 2 and versions[1][1] > 100
    assert [df.count() for df, _ in versions] == [600, 600] and versions[1][0].where("at = 1").count() == 3
    assert merge.compact(spark, root, "k", 20_000) == 2
    assert sorted(map(str, merge.read_table(spark, root).collect())) == sorted(map(str, versions[1][0].collect()))
    files = merge.manifest(spark, root).orderBy("least").collect()
    assert len(files) < 20 and all(a.most < b.least for a, b in zip(files, files[1:])) and sum(f.rows for f in files) == 600


def test_files_are_sized_by_measured_bytes(spark, tmp_path):
    """A partition of nearly all rows is dealt to files of half the target to the target; small ones and NULL are one file."""
    wide = spark.range(60_000, numPartitions=6).select("id", F.sha2(F.col("id").cast("string"), 512).alias("v"),
                                                       F.when(F.col("id") % 100 == 0, None).when(F.col("id") % 100 == 1, "b").otherwise("a").alias("p"))
    target = 500_000
    sinks.write_sized(wide, str(tmp_path / "t"), ["p"], ["id"], target, sample_rows=20_000)
    by_part = {}
    for name, size in _sizes(tmp_path / "t").items():
        by_part.setdefault(name.split("/p=")[1].split("/")[0], []).append(size)
    assert set(by_part) == {"a", "b", "__HIVE_DEFAULT_PARTITION__"}
    assert len(by_part["b"]) == len(by_part["__HIVE_DEFAULT_PARTITION__"]) == 1
    assert len(by_part["a"]) > 10 and target * 0.4 <= min(by_part["a"]) and max(by_part["a"]) <= 1.1 * target
    back = spark.read.parquet(str(tmp_path / "t"))
    assert sorted(map(str, back.select(*wide.columns).collect())) == sorted(map(str, wide.collect()))
    # another write replaces the partitions it holds, and an empty one none
    sinks.write_sized(wide.where("p = 'b' AND id < 1000"), str(tmp_path / "t"), ["p"], target_bytes=target)
    sinks.write_sized(wide.limit(0), str(tmp_path / "t"), ["p"], target_bytes=target)
    assert {r.p: r["count"] for r in spark.read.parquet(str(tmp_path / "t")).groupBy("p").count().collect()} == {"a": 58_800, "b": 10, None: 600}


def test_sketches_of_days_answer_for_all_days(spark):
    from rideflow.operators.quality import key_sketches, uniqueness, uniqueness_of

    days = spark.range(90_000).select(F.when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 50_000).cast("string").alias("k"), (F.col("id") % 9).alias("day"))
    stored = key_sketches(days, "k", ["day"])
    exact, about = uniqueness(days, "k").first(), uniqueness_of(stored).first()
    assert about.row_count == exact.row_count and abs(about.about_distinct_keys / exact.distinct_keys - 1) < 0.05
    # today's sketch joins the stored ones; keys known before count once
    more = key_sketches(days.where("day = 3"), "k", ["day"])
    assert uniqueness_of(stored.unionByName(more)).first().about_distinct_keys == about.about_distinct_keys
    assert {r.day: r.row_count for r in uniqueness_of(stored, ["day"]).collect()} == {d: 10_000 for d in range(9)}
    none = uniqueness_of(key_sketches(days.limit(0), "k", ["day"])).first()
    assert (none.row_count, none.about_distinct_keys) == (0, 0)
    assert uniqueness_of(key_sketches(days.where("k IS NULL"), "k", ["day"])).first().about_distinct_keys == 0
