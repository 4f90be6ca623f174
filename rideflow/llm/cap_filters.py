"""Near-duplicate vectors by spherical-cap filters from a structured random product code.

A rotation spreads a vector evenly over `BLOCKS` blocks. Every block has a small random code of unit directions; a filter direction
is one choice from each block, so there are side ** BLOCKS of them and none is ever stored. A vector is decoded to the list of all
directions whose inner product with it exceeds a bound: partial sums of two halves of the blocks, sorted, give the list
without visiting the other directions. Near vectors exceed many of the same directions, far ones hardly any; two
vectors are candidates if they have one filter in common, and the cosine decides.

The bound is set so that a random vector gets `FILTERS` filters on average, and a vector that gets fewer takes its
`FILTERS` best ones, which only adds candidates. The number of directions follows the number of vectors, so lists of a
filter stay short at every size.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rideflow.llm.graph import components
from rideflow.sources.workdir import materialize, work_dir

BLOCKS = 4
FILTERS = 48
MOST_DIRECTIONS = 64


def code_side(n_vectors: int) -> int:
    """Directions of a block: side ** BLOCKS is about 16 times the number of vectors, from 8 to 64 a block."""
    return int(min(MOST_DIRECTIONS, max(8, np.ceil((16 * max(n_vectors, 1)) ** (1 / BLOCKS)))))


@lru_cache(maxsize=8)
def _code(dim: int, side: int, seed: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Rotation, block codes (block, direction, coordinate) and bound, the same for a seed everywhere."""
    random = np.random.default_rng([seed, dim, side])
    width = -(-dim // BLOCKS) * BLOCKS
    rotation = np.linalg.qr(random.standard_normal((width, width)))[0][:dim]
    code = random.standard_normal((BLOCKS, side, width // BLOCKS))
    code /= np.linalg.norm(code, axis=2, keepdims=True) * np.sqrt(BLOCKS)
    share = min(0.5, FILTERS / side ** BLOCKS)
    return rotation, code, NormalDist().inv_cdf(1 - share) / np.sqrt(width)


def decode(vectors: np.ndarray, side: int, seed: int) -> list[np.ndarray]:
    """Filter numbers of each unit vector."""
    rotation, code, bound = _code(vectors.shape[1], side, seed)
    parts = (vectors @ rotation).reshape(len(vectors), BLOCKS, -1)
    scores = np.einsum("vbk,bsk->vbs", parts, code)
    low = (scores[:, 0, :, None] + scores[:, 1, None, :]).reshape(len(vectors), -1)
    high = (scores[:, 2, :, None] + scores[:, 3, None, :]).reshape(len(vectors), -1)
    order = np.argsort(-high, axis=1, kind="stable")
    found = []
    for a, b, by in zip(low, high, order, strict=True):
        falling = -b[by]
        least = bound
        while True:  # a vector with few filters lowers its own bound; what the others have remains
            many = np.searchsorted(falling, a - least, "right")
            if many.sum() >= min(FILTERS, len(a) * len(b)):
                break
            least = least - 0.05 * abs(bound) - 1e-3
        rows = np.repeat(np.arange(len(a)), many)
        nth = np.arange(len(rows)) - np.repeat(np.cumsum(many) - many, many)
        found.append(rows.astype(np.int64) * len(b) + by[nth])
    return found


def _cosine(x: Column, y: Column) -> Column:
    dot = F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)
    return dot


def cap_filter_links(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", group_col: str = "label",
                     threshold: float = 0.98, seed: int = 7) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of `vectors`.

    Two vectors link if their groups are equal and not null, their lengths are equal, and their cosine in double precision is at least
    `threshold`. Vectors that are null, empty, zero, or hold null or non-finite components link with nothing. Equal
    vectors of a group are one class: its members link with each other and with what the class links with, counted, not paired.
    n_links counts other vectors (a second row of the same id is another vector), component_id is the smallest id that links
    reach, kept says whether it is the row's own. Rows without an id: counted in n_links, component of what they link with. Candidates
    come from filters, so a link may be missed with a small probability; none below the threshold is returned. Other columns are ignored.
    """
    spark = vectors.sparkSession
    plain = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(group_col).alias("grp"), plain.alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    biggest = F.array_max(F.transform("v", F.abs))
    good = F.coalesce(F.col("grp").isNotNull() & finite & (biggest > 0), F.lit(False))
    # divided by its largest component first, so that squares neither overflow nor vanish; + 0.0 turns -0.0 into 0.0
    scaled = F.transform("v", lambda x: x / biggest + F.lit(0.0))
    rows = rows.withColumn("good", good).withColumn("v", F.when(F.col("good"), scaled))
    rows = rows.withColumn("class_key", F.when(F.col("good"), F.sha2(F.concat_ws("/", F.col("grp").cast("string"), F.array_join(
        F.transform("v", lambda x: x.cast("string")), ",")), 256)))
    rows = materialize(rows, work_dir(spark))
    classes = (rows.where("good").groupBy("class_key")
               .agg(F.first("grp").alias("grp"), F.first("v").alias("v"), F.min("vec_id").alias("least"), F.count("*").alias("size")))
    norm = F.sqrt(_cosine(F.col("v"), F.col("v")))
    classes = classes.withColumn("norm", norm).withColumn("v", F.transform("v", lambda x: x / F.col("norm"))).drop("norm")
    # read back from files, so the numbers given here stay
    classes = materialize(classes.withColumn("class", F.monotonically_increasing_id()), work_dir(spark))
    side = code_side(classes.count())

    def filters(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for _, part in frame.groupby(frame["v"].map(len)):
                for start in range(0, len(part), 256):
                    some = part.iloc[start:start + 256]
                    lists = decode(np.stack(some["v"].to_numpy()).astype(np.float64), side, seed)
                    many = [len(x) for x in lists]
                    yield pd.DataFrame({"class": np.repeat(some["class"].to_numpy(), many),
                                        "place": np.repeat(some["place"].to_numpy(), many), "filter": np.concatenate(lists)})

    keyed = classes.select("class", "v", F.xxhash64("grp", F.size("v")).alias("place"))
    entries = materialize(keyed.mapInPandas(filters, "class long, place long, filter long"), work_dir(spark))
    pairs = (entries.select("place", "filter", F.col("class").alias("a"))
             .join(entries.select("place", "filter", F.col("class").alias("b")), ["place", "filter"])
             .where("a < b").select("a", "b").distinct())
    one = classes.select(F.col("class").alias("a"), F.col("v").alias("va"), F.col("grp").alias("ga"))
    two = classes.select(F.col("class").alias("b"), F.col("v").alias("vb"), F.col("grp").alias("gb"))
    links = materialize(pairs.join(one, "a").join(two, "b")
                        .where((F.col("ga") == F.col("gb")) & (F.size("va") == F.size("vb"))
                               & (_cosine(F.col("va"), F.col("vb")) >= threshold)).select("a", "b"), work_dir(spark))
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    sizes = classes.select(F.col("class").alias("b"), "size")
    degree = both.join(sizes, "b").groupBy("a").agg(F.sum("size").alias("others")).withColumnRenamed("a", "class")
    parts = components(links).withColumnsRenamed({"node": "class"})
    known = (classes.select("class", "class_key", "least", "size").join(degree, "class", "left").join(parts, "class", "left")
             .withColumn("label", F.coalesce("label", "class")))
    known = materialize(known, work_dir(spark))
    roots = known.groupBy("label").agg(F.min("least").alias("root"))
    known = known.join(roots, "label").select("class_key", (F.col("size") - 1 + F.coalesce("others", F.lit(0))).alias("n"), "root")
    done = materialize(rows.select("vec_id", "class_key").join(known, "class_key", "left")
                       .select("vec_id", F.coalesce("n", F.lit(0)).alias("n_links"),
                               F.coalesce("root", "vec_id").alias("component_id")), work_dir(spark))
    # an id on several rows holds their components together
    split = done.groupBy("vec_id").agg(F.min("component_id").alias("lo"), F.max("component_id").alias("hi")).where("lo < hi")
    ties = done.join(split.select("vec_id", "lo"), "vec_id").select(F.col("component_id").alias("a"), F.col("lo").alias("b"))
    merged = components(ties).withColumnsRenamed({"node": "component_id", "label": "least"})
    result = done.join(merged, "component_id", "left").withColumn("component_id", F.coalesce("least", "component_id"))
    return result.select("vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept"))
