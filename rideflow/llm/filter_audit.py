"""Interaction audit of document filters by path counting on the lattice of filter sets.

A state is the set of filters that were applied so far, an edge adds one filter, and an order of the filters is a path from the
empty set to the full one. What a filter removes depends on the state it meets and not on how that state was reached, so every order
reads its steps from the same n * 2**(n-1) edges. Counting forward gives the orders that reach a state, counting backward those that
lead on from it; the removals of an edge times both counts, summed over a filter's edges, are its removals over all orders (its
Shapley value times the number of orders), without going through the orders one by one.

Only the filter results of a document matter: documents are first counted by part, set of failed filters and marks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MOST_FILTERS = 8


def _needs(n: int, before: Iterable[tuple[int, int]]) -> list[int]:
    """For each filter the state that must have been passed before it."""
    needs = [0] * n
    for a, b in before:
        needs[b] |= 1 << a
    return needs


def count_paths(n: int, before: Iterable[tuple[int, int]] = ()) -> tuple[list[int], list[int]]:
    """For each of the 2**n states: the paths from the empty state to it, and from it to the full state. A pair (a, b) in `before` forbids the
    orders that apply filter b ahead of filter a; states that no allowed order passes get 0."""
    needs = _needs(n, before)
    reach, leave = [0] * (1 << n), [0] * (1 << n)
    reach[0] = leave[-1] = 1
    steps = [(s, s | 1 << f) for s in range(1 << n) for f in range(n) if not s >> f & 1 and s & needs[f] == needs[f]]
    for s, t in steps:
        reach[t] += reach[s]
    for s, t in reversed(steps):
        leave[s] += leave[t]
    return reach, leave


def orders(n: int, before: Iterable[tuple[int, int]] = ()) -> Iterator[tuple[int, ...]]:
    """All allowed orders of the filters 0 to n - 1, lexicographically."""
    before = list(before)

    def go(done: tuple[int, ...]) -> Iterator[tuple[int, ...]]:
        if len(done) == n:
            yield done
        for f in range(n):
            if f not in done and all(a in done for a, b in before if b == f):
                yield from go((*done, f))

    return go(())


def count_repeats(rows: DataFrame, id_col: str, key: str, carried: list[str]) -> DataFrame:
    """`carried`, `repeat`, `n`: rows counted by the carried columns and by whether a smaller id has the same `key`.

    A row with a null id repeats nothing and is repeated by nothing; rows that share key and id do not repeat each other. Rows meet
    as counts: a key that most rows share leaves a task as one row for each combination of the carried columns and each id."""
    each = rows.groupBy(key, *carried, id_col).agg(F.count("*").alias("n"))
    named = F.when(F.col(id_col).isNotNull(), F.col("n"))
    met = each.groupBy(key, *carried).agg(
        F.sum("n").alias("n"), F.coalesce(F.sum(named), F.lit(0)).alias("named"), F.min(id_col).alias("least"), F.min_by("n", id_col).alias("at_least"))
    # a group has one row for each combination of the carried columns
    first = F.min("least").over(Window.partitionBy(key))
    repeated = F.col("named") - F.when(F.col("least") == F.col("first"), F.col("at_least")).otherwise(0)
    split = F.array(F.struct(F.lit(True).alias("repeat"), F.col("repeated").alias("n")),
                    F.struct(F.lit(False).alias("repeat"), (F.col("n") - F.col("repeated")).alias("n")))
    counted = met.withColumn("first", first).withColumn("repeated", repeated).select(*carried, F.inline(split)).where("n > 0")
    return counted.groupBy(*carried, "repeat").agg(F.sum("n").alias("n"))


def audit_filters(rows: DataFrame, filters: dict[str, Column], part: Column, marks: dict[str, Column], weight: Column | None = None,
                  before: Iterable[tuple[str, str]] = ()) -> DataFrame:
    """One row for every part, allowed order and step, zeros included: part, filter_order (names in a row), step (from 1), filter, the
    documents kept after the step, removed in it, redundant (they fail its filter, but an earlier one took them), unique_fails (they
    fail its filter only), `<mark>_lost` for each mark (removed in the step and marked) and shapley (what the filter removes, summed
    over all allowed orders, at whatever step).

    `filters` give a name to each failure condition; a null condition does not fail, a null mark is not set, a null part is the empty
    string. `weight` is how many documents a row stands for (1). Other columns of `rows` are ignored, whatever their names; repeated rows count
    each; no rows give no parts. All orders are listed, so there may be at most MOST_FILTERS filters."""
    names = list(filters)
    n = len(names)
    if not 1 <= n <= MOST_FILTERS:
        raise ValueError(f"between 1 and {MOST_FILTERS} filters, got {n}")
    before = [(names.index(a), names.index(b)) for a, b in before]
    reach, leave = count_paths(n, before)
    failed = sum((F.coalesce(c, F.lit(False)).cast("int") * (1 << i) for i, c in enumerate(filters.values())), F.lit(0))
    flags = [F.coalesce(c, F.lit(False)).alias(f"mark{i}") for i, c in enumerate(marks.values())]
    slim = rows.select(F.coalesce(part.cast("string"), F.lit("")).alias("part"), failed.alias("failed"), *flags,
                       (F.lit(1) if weight is None else weight).cast("long").alias("n"))
    # at most 2**(filters + marks) rows a part from here on
    counts = slim.groupBy("part", "failed", *[f"mark{i}" for i in range(len(marks))]).agg(F.sum("n").alias("n"))

    edges = (counts.withColumn("state", F.explode(F.sequence(F.lit(0), F.lit((1 << n) - 1))))
             .withColumn("place", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
             .withColumn("bit", F.element_at(F.lit([1 << i for i in range(n)]), F.col("place") + 1))
             .withColumn("needs", F.element_at(F.lit(_needs(n, before)), F.col("place") + 1))
             .where((F.col("state").bitwiseAND(F.col("bit")) == 0) & (F.col("state").bitwiseAND(F.col("needs")) == F.col("needs"))))
    fails = F.col("failed").bitwiseAND(F.col("bit")) != 0
    met = F.col("failed").bitwiseAND(F.col("state")) == 0
    total = lambda condition: F.sum(F.when(condition, F.col("n")).otherwise(0))
    measured = edges.groupBy("part", "state", "place", "bit").agg(
        total(met & ~fails).alias("kept"), total(met & fails).alias("removed"), total(~met & fails).alias("redundant"),
        total(F.col("failed") == F.col("bit")).alias("unique_fails"),
        *[total(met & fails & F.col(f"mark{i}")).alias(f"{mark}_lost") for i, mark in enumerate(marks)])
    through = F.element_at(F.lit(reach), F.col("state") + 1) * F.element_at(F.lit(leave), F.col("state").bitwiseOR(F.col("bit")) + 1)
    weighed = measured.withColumn("shapley", F.sum(F.col("removed") * through).over(Window.partitionBy("part", "place")))

    steps = [("".join(names[f] for f in order), k + 1, sum(1 << f for f in order[:k]), f, names[f])
             for order in orders(n, before) for k, f in enumerate(order)]
    listed = rows.sparkSession.createDataFrame(steps, "filter_order string, step int, state int, place int, filter string")
    return weighed.join(listed, ["state", "place"]).select(
        "part", "filter_order", "step", "filter", "kept", "removed", "redundant", "unique_fails", *[f"{mark}_lost" for mark in marks], "shapley")
