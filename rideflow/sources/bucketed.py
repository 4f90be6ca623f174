"""Facts laid out for joins without a shuffle: catalog tables in equal buckets of the join key, sorted by time.

A key that holds more rows than a bucket should would make one bucket, and so one task of every join, as large as itself. Such keys are dealt: their
rows on the large side get a salt and go to several buckets, and the rows of the other side are there in as many copies. Key and salt
together are the bucket columns, so the join needs no exchange on either side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rideflow.sources.workdir import materialize, work_dir

SALT = "_salt"


def _rows_by_key(df: DataFrame, key: str) -> tuple[DataFrame, int]:
    """Rows by key, stored, and all rows with a key."""
    counts = materialize(df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")), work_dir(df.sparkSession))
    return counts, counts.agg(F.sum("n")).first()[0] or 0


def hot_keys(df: DataFrame, key: str, buckets: int, share: float = 0.5) -> dict[object, int]:
    """Keys with more rows than `share` of a mean bucket, and to how many buckets each is to be dealt. There are at most buckets / share
    of them, whatever the data."""
    return _hot(*_rows_by_key(df, key), buckets, share)


def _hot(counts: DataFrame, rows: int, buckets: int, share: float) -> dict[object, int]:
    limit = rows / buckets * share
    return {r[0]: min(buckets, int(-(-r.n // max(1, limit)))) for r in counts.where(F.col("n") > max(1, limit)).collect()}


def _parts(key: str, hot: dict[object, int]) -> Column:
    """To how many buckets the row's key is dealt."""
    if not hot:
        return F.lit(1)
    found = F.lit(None).cast("int")
    for parts in sorted(set(hot.values())):
        found = F.when(F.col(key).isin([k for k, n in hot.items() if n == parts]), F.lit(parts)).otherwise(found)
    return F.coalesce(found, F.lit(1))


def _save(df: DataFrame, table: str, path: str, key: str, sort: str, buckets: int) -> None:
    # the same hash deals the rows to tasks and to buckets, so every task writes one file of one bucket
    (df.repartition(buckets, key, SALT).sortWithinPartitions(key, SALT, sort).write.mode("overwrite").option("path", path)
     .bucketBy(buckets, key, SALT).sortBy(key, SALT, sort).saveAsTable(table))


def save_for_join(dealt: DataFrame, copied: DataFrame, tables: tuple[str, str], root: str, key: str, sort: tuple[str, str], buckets: int,
                  share: float = 0.5, bucket_rows: int = 1_000_000) -> dict[object, int]:
    """Store two facts as catalog tables in `buckets` buckets of `key`, or in more where a bucket of `dealt` would hold over `bucket_rows` rows: a bucket is
    one task of the join, so tasks grow in number and not in size. Hot keys of `dealt` are spread over buckets, and the rows of `copied` with such a key are stored once in
    each of them. Rows without a key lie where their other columns put them. Returns the hot keys and their buckets."""
    counts, rows = _rows_by_key(dealt, key)
    buckets = max(buckets, -(-rows // bucket_rows))
    hot = _hot(counts, rows, buckets, share)
    parts = _parts(key, hot)
    any_of = F.pmod(F.xxhash64(*dealt.columns), F.when(F.col(key).isNull(), F.lit(buckets)).otherwise(parts)).cast("int")
    _save(dealt.withColumn(SALT, any_of), tables[0], f"{root}/{tables[0]}", key, sort[0], buckets)
    copies = F.when(F.col(key).isNull(), F.array(F.pmod(F.xxhash64(*copied.columns), F.lit(buckets)).cast("int"))).otherwise(F.sequence(F.lit(0), parts - 1))
    _save(copied.withColumn(SALT, F.explode(copies)), tables[1], f"{root}/{tables[1]}", key, sort[1], buckets)
    return hot


def dealt_rows(spark: SparkSession, table: str) -> DataFrame:
    """The rows of the dealt table."""
    return spark.table(table).drop(SALT)


def copied_rows(spark: SparkSession, table: str, key: str) -> DataFrame:
    """The rows of the copied table, once each."""
    return spark.table(table).where((F.col(SALT) == 0) | F.col(key).isNull()).drop(SALT)


def join_stored(spark: SparkSession, tables: tuple[str, str], key: str, how: str = "inner") -> DataFrame:
    """The dealt table joined to the copied one on the key, without an exchange. `how` is inner, left, left_semi or left_anti; other joins would
    return copies."""
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"{how} is not a join that keeps to the rows of the dealt table")
    return spark.table(tables[0]).join(spark.table(tables[1]).hint("merge"), [key, SALT], how).drop(SALT)
