"""Current state of a stream: one row per key, in parts by hash of the key, with a generation for every batch.

A batch rewrites only the parts its keys fall into and then publishes a manifest that names the folder of every part. The manifest counts once it
is complete, so a batch that fails between its two writes leaves the generation before it; replayed, it starts from there again. A batch that
has been published changes nothing when it is delivered again. Readers take the newest generation or hold on to one that they name.
A key holds one row, so parts are of equal size whatever the keys of the events; choose their number so that one is a good file.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rideflow.operators.dedupe import latest_per_key

PARTS = 64
_PART = "_part"


def generations(spark: SparkSession, root: str) -> list[int]:
    """The complete generations, oldest first; empty where there is none."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/manifest/generation=*/_SUCCESS")
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in found or [])


def upsert_state(root: str, key: list[str], order: list[str], parts: int = PARTS) -> Callable[[DataFrame, int], None]:
    """Batch handler that keeps the newest row per key: the largest by `order`, of equal ones that of the later batch, then the largest by the
    other columns. Without `order` every batch replaces the rows of its keys. `parts` counts when the state begins; `rehash` changes it."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        known = generations(spark, root)
        if known and known[-1] >= batch_id:
            return
        held = _folders(spark, root, known[-1]) if known else {}
        count = _parts(spark, root, known[-1]) if known else parts
        folder = f"data/{uuid.uuid4().hex}"
        latest_per_key(batch, key, order).withColumn(_PART, _part_of(key, count)).write.parquet(f"{root}/{folder}/changes")
        changes = spark.read.parquet(f"{root}/{folder}/changes")
        hit = sorted(r[0] for r in changes.select(_PART).distinct().collect())
        if hit:
            both = changes.withColumn("_change", F.lit(1))
            old = [f"{root}/{held[p]}" for p in hit if p in held]
            if old:
                both = both.unionByName(spark.read.schema(batch.schema).parquet(*old).withColumn(_PART, _part_of(key, count)).withColumn("_change", F.lit(0)))
            # dealt by part, which also brings the rows of a key together: one exchange
            dealt = both.repartition(len(hit), _PART)
            merged = latest_per_key(dealt, [_PART, *key], [*order, "_change"]).drop("_change")
            merged.write.partitionBy(_PART).parquet(f"{root}/{folder}/rows")
        _publish(spark, root, batch_id, count, held | {p: f"{folder}/rows/{_PART}={p}" for p in hit})

    return handle


def read_state(spark: SparkSession, root: str, schema: T.StructType, generation: int | None = None) -> DataFrame:
    """The rows of a generation, the newest by default; no rows before the first batch."""
    known = generations(spark, root)
    if generation is not None and generation not in known:
        raise ValueError(f"no generation {generation} of a state at {root}")
    folders = _folders(spark, root, known[-1] if generation is None else generation) if known else {}
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{root}/{f}" for _, f in sorted(folders.items())])


def rehash(spark: SparkSession, root: str, schema: T.StructType, key: list[str], target: str, parts: int) -> None:
    """The newest generation as the only one of a new state at `target` with another number of parts. It keeps its number, so the stream goes on there."""
    number = generations(spark, root)[-1]
    rows = read_state(spark, root, schema, number).withColumn(_PART, _part_of(key, parts))
    folder = f"data/{uuid.uuid4().hex}"
    rows.repartition(parts, _PART).write.partitionBy(_PART).parquet(f"{target}/{folder}/rows")
    found = spark.read.parquet(f"{target}/{folder}/rows").select(_PART).distinct().collect()
    _publish(spark, target, number, parts, {r[0]: f"{folder}/rows/{_PART}={r[0]}" for r in found})


def forget(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete all generations but the last `keep`, and every folder that none of those names. No batch may run, and no reader may still use an
    older generation. Returns the folders."""
    known = generations(spark, root)
    named = {f for g in known[-keep:] for f in _folders(spark, root, g).values()}
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    system = hadoop(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    stored = [f.getPath() for pattern in ("data/*/rows/*", "data/*/changes") for f in system.globStatus(hadoop(f"{root}/{pattern}")) or []]
    relative = {"data/" + p.toString().split("/data/")[-1]: p for p in stored}
    gone = sorted(f for f in relative if f not in named and not f.endswith("_SUCCESS"))
    for folder in gone:
        system.delete(relative[folder], True)
    for generation in known[:-keep]:
        system.delete(hadoop(f"{root}/manifest/generation={generation}"), True)
    return gone


def _part_of(key: list[str], parts: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(parts)).cast("int")


def _manifest(spark: SparkSession, root: str, generation: int) -> DataFrame:
    return spark.read.parquet(f"{root}/manifest/generation={generation}")


def _folders(spark: SparkSession, root: str, generation: int) -> dict[int, str]:
    """Folder of every part that has rows: at most as many as there are parts."""
    return {r.part: r.folder for r in _manifest(spark, root, generation).filter("part >= 0").collect()}


def _parts(spark: SparkSession, root: str, generation: int) -> int:
    return _manifest(spark, root, generation).first().parts


def _publish(spark: SparkSession, root: str, generation: int, parts: int, folders: dict[int, str]) -> None:
    # part -1 stands for the state as a whole, so that one without rows is known as well
    rows = [(part, folder, parts) for part, folder in sorted(folders.items())] + [(-1, "", parts)]
    written = spark.createDataFrame(rows, "part int, folder string, parts int").coalesce(1)
    # what an attempt that failed here has left is no generation yet
    written.write.mode("overwrite").parquet(f"{root}/manifest/generation={generation}")
