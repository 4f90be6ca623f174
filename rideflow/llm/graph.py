"""Connected components of a table of links, as Spark jobs."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rideflow.sources.workdir import materialize, work_dir


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of `links` (a, b: non-null longs): the smallest node reachable.

    Alternating star contraction: in a "large star" every node sends its larger neighbours to its smallest one, in a
    "small star" its smaller neighbours and itself. Each step is one grouped minimum and one join on the node,
    which adaptive execution can split for a node with very many links, and it never makes more links
    than there were. The number of steps grows with the logarithm of the links' longest path. Every step is a table in
    the shared folder, so lost executors cost a step at most. Loops (a = b) and repeated links are allowed;
    an empty table gives an empty result.
    """
    spark = links.sparkSession
    nodes = links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node"))).distinct()
    edges = materialize(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                        .distinct(), work_dir(spark))
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialize(large, work_dir(spark))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = materialize(joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                            .unionByName(low.select("u", F.col("m").alias("v"))).distinct(), work_dir(spark))
        if _sums(small) == _sums(edges):
            break
        edges = small
    labels = edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return nodes.join(labels, "node", "left").select("node", F.coalesce("label", "node").alias("label"))


def _sums(edges: DataFrame) -> tuple:
    """Count and an order-free hash: equal for equal sets of links."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.hash("u", "v").cast("long"))).first())


def discard(spark: SparkSession, path: str) -> None:
    """Delete the scratch tables under `path`. Nothing that is still to run may read them: later steps start from tables of their own."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps now. It does so once the driver's JVM has found them unreferenced, which on a
    large heap can be long after the last job that read them."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
