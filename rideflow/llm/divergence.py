"""Divergence of sources: how far apart the term distributions of groups lie, from a quadtree over the matrix of their counts.

Rows of the matrix are the groups of one language, columns its terms, most widespread first, so that the rare ones on the right leave
large areas empty. A term that a group lacks has the same smoothed probability in that group whatever the term. So an area in which two
groups have no count adds its width times one difference, and only what lies under the non-empty quadrants of either group is looked at cell by cell.

The tree is cut in two. Its upper levels are rows of Spark tables: tiles of SIDE by SIDE cells, dealt by (language, column of tiles,
pair of rows of tiles), so a task holds two tiles at most, however many groups and terms there are. Inside, each level of the tree is a bitmap,
and both tiles are walked down together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rideflow.llm.positions import with_position
from rideflow.llm.words import text_slices
from rideflow.sources.workdir import materialize, work_dir

LEVELS = 8
SIDE = 1 << LEVELS
SCALE = 1_000_000_000
SMOOTHING = 5
_NODES = 1 << 16
_SLICE = 8 << 20

_in_term = np.zeros(256, bool)
_in_term[0x41:0x5B] = _in_term[0x61:0x7B] = _in_term[0x80:] = True
_lower = np.arange(256, dtype=np.uint8)
_lower[0x41:0x5B] += 32


def terms_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, pa.DictionaryArray]:
    """The number of the text and the term, in order, of all terms of some texts: longest runs of ASCII letters, lower-cased, and of
    characters beyond ASCII. `data` holds the UTF-8 bytes, `offsets` where each text starts."""
    solid = _in_term[data]
    # a byte ends a run if the next one is not part of a term or belongs to the next text
    opens, closes = solid.copy(), solid.copy()
    opens[1:] &= ~solid[:-1]
    closes[:-1] &= ~solid[1:]
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    opens[first] = solid[first]
    closes[first[first > 0] - 1] = solid[first[first > 0] - 1]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    bounds = np.concatenate(([0], np.cumsum(end - start, dtype=np.int64)))
    joined = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(bounds), pa.py_buffer(_lower[data[solid]]))
    return np.searchsorted(offsets, start, "right") - 1, joined.dictionary_encode()


def count_terms(docs: DataFrame, groups: list[Column], text: Column) -> DataFrame:
    """The group columns (g0, g1, ...), term, n (occurrences in the group), docs (rows of the group that hold it). Texts are counted in the tasks; what leaves
    a task is one row for each of its groups and terms. Null groups and texts count as empty strings."""
    names = [f"g{i}" for i in range(len(groups))]
    slim = docs.select(*[F.coalesce(g.cast("string"), F.lit("")).alias(c) for g, c in zip(groups, names, strict=True)],
                       F.coalesce(text.cast("string"), F.lit("")).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = list(zip(*[batch.column(i).to_pylist() for i in range(len(names))], strict=True))
            found = {k: i for i, k in enumerate(dict.fromkeys(keys))}
            group = np.fromiter((found[k] for k in keys), np.int64, len(keys))
            for row, end, data, offsets in text_slices(batch.column(len(names)), _SLICE):
                text_of, terms = terms_of(data, offsets)
                width = len(terms.dictionary)
                if not width:
                    continue
                cells, n = np.unique(text_of * width + terms.indices.to_numpy(), return_counts=True)
                owner = group[row:end][cells // width] * width + cells % width
                pairs, place, held = np.unique(owner, return_inverse=True, return_counts=True)
                total = np.bincount(place, n).astype(np.int64)
                columns = [pa.array(list(column), pa.string()).take(pa.array(pairs // width)) for column in zip(*found, strict=True)]
                term = terms.dictionary.take(pa.array(pairs % width)).cast(pa.string())
                yield pa.RecordBatch.from_arrays([*columns, term, pa.array(total), pa.array(held.astype(np.int64))], names=[*names, "term", "n", "docs"])

    counted = slim.mapInArrow(count, ", ".join([f"{c} string" for c in names] + ["term string", "n long", "docs long"]))
    return counted.groupBy(*names, "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def pyramid(rows: np.ndarray, columns: np.ndarray) -> list[np.ndarray]:
    """The bitmaps of the tree over the given non-zero cells of a tile: `[l][r, c]` tells whether the quadrant of 2**l by 2**l cells has any."""
    level = np.zeros((SIDE, SIDE), bool)
    level[rows, columns] = True
    levels = [level]
    for _ in range(LEVELS):
        level = level[::2] | level[1::2]
        level = level[:, ::2] | level[:, 1::2]
        levels.append(level)
    return levels


def walk(left: list[np.ndarray], right: list[np.ndarray], n_left: int, n_right: int, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row of left, row of right, column) of the cells under quadrants that are not empty in both trees, in chunks. Rows from n_left and n_right on do
    not exist; of a tile with itself, pairs with row of left < row of right come out."""
    zero = np.zeros(1, np.int32)
    stack = [(LEVELS, zero, zero, zero)]
    step = np.arange(8, dtype=np.int32)
    while stack:
        level, a, b, c = stack.pop()
        held = left[level][a, c] | right[level][b, c]
        held &= (a << level < n_left) & (b << level < n_right) & ((a <= b) if same else True)
        a, b, c = a[held], b[held], c[held]
        if not level:
            apart = a < b if same else slice(None)
            yield a[apart], b[apart], c[apart]
            continue
        for k in range(0, len(a), _NODES):
            children = (((x[k:k + _NODES, None] << 1) + (step >> i & 1)).ravel() for i, x in enumerate((a, b, c)))
            stack.append((level - 1, *children))


def _tile_pairs(cells: pd.DataFrame) -> pd.DataFrame:
    """Sums over the cells that `walk` finds, for every pair of groups in two tiles. Rows without a column state the probability of terms the group lacks."""
    low, high = cells["low"].iat[0], cells["high"].iat[0]
    sides = []
    for place in (low, high):
        own = cells[cells["tile_row"] == place]
        absent, present = own[own["col"] < 0], own[own["col"] >= 0]
        values = np.zeros((SIDE, SIDE), np.int64)
        values[absent["row"].to_numpy() % SIDE] = absent["p"].to_numpy()[:, None]
        at = present["row"].to_numpy() % SIDE, present["col"].to_numpy() % SIDE
        values[at] = present["p"].to_numpy()
        sides.append((values, pyramid(*at), len(absent)))
    (x, left, n), (y, right, m) = sides
    apart, seen = np.zeros(SIDE * SIDE), np.zeros(SIDE * SIDE, np.int64)
    for a, b, c in walk(left, right, n, m, low == high):
        pair = a.astype(np.int64) * SIDE + b
        # sums of at most SIDE differences of at most SCALE, exact in double precision
        apart += np.bincount(pair, np.abs(x[a, c] - y[b, c]), SIDE * SIDE)
        seen += np.bincount(pair, minlength=SIDE * SIDE)
    found = np.flatnonzero(seen)
    return pd.DataFrame({"lang": cells["lang"].iat[0], "a": low * SIDE + found // SIDE, "b": high * SIDE + found % SIDE,
                         "apart": apart[found].astype(np.int64), "seen": seen[found]})


def _probability(count: str, total: str) -> Column:
    """Smoothed count over smoothed total, in parts of SCALE, exact. Decimals, as the product outgrows a long."""
    return F.expr(f"1 + (cast({count} as decimal(19, 0)) + {SMOOTHING}) * cast({SCALE} as decimal(10, 0)) div cast({total} as decimal(19, 0))")


def source_divergence(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", least_docs: int = 30,
                      top: int = 50) -> DataFrame:
    """lang, source, part, item, value, rank for every (lang, source) group of `docs`.

    Part `pair`: item is each other source of the language, value the sum of the differences of the two groups' term probabilities over all terms
    of the language, in all ranks. Part `term`: item is each term more likely in the group, which has it, than in the language, value by how
    much, up to rank `top`. A language's terms are those in at least `least_docs` of its rows. Equal values rank by item. Null groups and
    texts count as empty strings, repeated rows count each, other columns are ignored; no rows give no groups."""
    spark = docs.sparkSession
    scratch = work_dir(spark)
    lang, source = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (lang_col, source_col))
    counts = count_terms(docs, [lang, source], F.col(text_col)).withColumnsRenamed({"g0": "lang", "g1": "source"})
    counts = materialize(counts, f"{scratch}/counts")

    def numbered(table: DataFrame, order: list[Column], name: str) -> DataFrame:
        """`table` with each row's number within its language."""
        placed = with_position(table, [F.col("lang"), *order])
        first = placed.groupBy("lang").agg(F.min("position").alias("first"))
        return materialize(placed.join(first, "lang").withColumn(name, F.col("position") - F.col("first")).drop("position", "first"), f"{scratch}/{name}")

    terms = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("total")).where(F.col("docs") >= least_docs)
    terms = numbered(terms, [F.desc("docs"), F.col("term")], "col").drop("docs")
    cells = materialize(counts.join(terms, ["lang", "term"]), f"{scratch}/cells")

    langs = terms.groupBy("lang").agg(F.count("*").alias("width"), F.sum("total").alias("lang_size"))
    sizes = cells.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    groups = numbered(docs.select(lang.alias("lang"), source.alias("source")).distinct(), [F.col("source")], "row")
    groups = groups.join(sizes, ["lang", "source"], "left").join(langs, "lang", "left").withColumn("size", F.coalesce("size", F.lit(0)))
    groups = materialize(groups.withColumn("whole", F.col("size") + SMOOTHING * F.col("width"))
                         .withColumn("absent", _probability("0", "whole")), f"{scratch}/groups")
    likely = cells.join(groups, ["lang", "source"]).withColumn("p", _probability("n", "whole"))

    # the tiles: every group states its probability of absent terms once in each column of tiles
    present = likely.select("lang", "row", "col", "p", F.expr(f"col div {SIDE}").alias("tile_col"))
    absent = groups.where("width > 0").select("lang", "row", F.lit(-1).cast("long").alias("col"), F.col("absent").alias("p"),
                                              F.explode(F.expr(f"sequence(0L, (width - 1) div {SIDE})")).alias("tile_col"))
    tiled = present.unionByName(absent).withColumn("tile_row", F.expr(f"row div {SIDE}"))
    depth = groups.groupBy("lang").agg(F.expr(f"max(row) div {SIDE}").alias("last"))
    paired = (tiled.join(depth, "lang").withColumn("other", F.explode(F.expr("sequence(0L, last)"))).drop("last")
              .withColumn("low", F.least("tile_row", "other")).withColumn("high", F.greatest("tile_row", "other")).drop("other"))
    sums = (paired.groupBy("lang", "tile_col", "low", "high").applyInPandas(_tile_pairs, "lang string, a long, b long, apart long, seen long")
            .groupBy("lang", "a", "b").agg(F.sum("apart").alias("apart"), F.sum("seen").alias("seen")))

    side = lambda name: groups.select("lang", *[F.col(c).alias(f"{c}_{name}") for c in ("source", "row", "absent", "width")])
    # every pair of sources of a language is a row of the result
    pairs = side("a").join(side("b").drop("width_b"), "lang").where("row_a < row_b")
    met = pairs.join(sums, (pairs["lang"] == sums["lang"]) & (F.col("row_a") == F.col("a")) & (F.col("row_b") == F.col("b")), "left").drop(sums["lang"])
    empty = (F.col("width_a") - F.coalesce("seen", F.lit(0))) * F.abs(F.col("absent_a") - F.col("absent_b"))
    valued = met.withColumn("value", F.coalesce(F.coalesce("apart", F.lit(0)) + empty, F.lit(0)))
    both = valued.select("lang", "value", F.inline(F.array(*[F.struct(F.col(f"source_{x}").alias("source"), F.col(f"source_{y}").alias("item"))
                                                             for x, y in ("ab", "ba")])))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.col("item"))
    pair = both.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))

    typical = _probability("total", f"(lang_size + {SMOOTHING} * width)")
    risen = likely.select("lang", "source", F.col("term").alias("item"), (F.col("p") - typical).alias("value")).where("value > 0")
    term = risen.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return pair.unionByName(term.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))
