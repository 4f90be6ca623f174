"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of `PASSAGE` words that together hold its whole text. Every passage becomes a vector of shares: kinds of
bytes, shapes and repetitions of words. A tanh layer encodes it, gated attention (tanh times sigmoid of two further
layers) weighs the passages against each other, and the weighted sum of the codes gives the document's probability. Only
documents have labels; which passages matter is learned.

Fitting takes a bounded number of labelled documents and of their passages, whose vectors come to the driver; scoring runs in the tasks over
all passages of all texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rideflow.llm.pareto_mix import n_words
from rideflow.llm.words import mix, text_slices, words
from rideflow.sources.workdir import materialize, work_dir

PASSAGE = 64
HIDDEN, GATE = 16, 8
MAX_TRAIN = 6000
MAX_PASSAGES = 250_000

# kinds of bytes: each ASCII character that is no letter or digit by itself, then digits, A-Z, a-z, the rest of UTF-8
_kind = np.arange(256)
_kind[48:58], _kind[65:91], _kind[97:123], _kind[128:] = 0, 1, 2, 3
_, _kind = np.unique(_kind, return_inverse=True)
KINDS = int(_kind.max()) + 1
SHAPES = 7
FEATURES = KINDS + SHAPES


def passage_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(vectors of the passages, number of passages of each text). A text without words is one passage of zeros."""
    found = words(data, offsets, lower=False)
    per_text = np.diff(found.bounds)
    many = np.maximum(1, -(-per_text // PASSAGE))
    first = np.concatenate(([0], np.cumsum(many)))
    total = int(first[-1])
    owner = np.repeat(np.arange(len(per_text)), per_text)
    nth = np.arange(len(owner)) - found.bounds[owner]
    passage = first[owner] + nth // PASSAGE
    vectors = np.zeros((total, FEATURES))
    if not len(owner):
        return vectors, many
    n_words = np.bincount(passage, minlength=total)
    size = np.maximum(n_words, 1)
    # bytes belong to the passage of the last word that began; those in front of a first word belong to none
    begins = np.full(len(data), -1, np.int64)
    begins[found.start] = passage
    begins[offsets[:-1][np.diff(offsets) > 0]] = np.where(
        np.isin(offsets[:-1][np.diff(offsets) > 0], found.start), begins[offsets[:-1][np.diff(offsets) > 0]], total)
    marks = np.flatnonzero(begins >= 0)
    at = np.repeat(begins[marks], np.diff(np.concatenate((marks, [len(data)]))))
    kinds = np.bincount(at * KINDS + _kind[data[marks[0]:]], minlength=(total + 1) * KINDS)[:total * KINDS].reshape(total, KINDS)
    vectors[:, :KINDS] = np.sqrt(kinds / np.maximum(kinds.sum(axis=1, keepdims=True), 1))
    length = found.end - found.start
    letter = np.concatenate(([0], np.cumsum((_kind[data] == _kind[97]) | (_kind[data] == _kind[65]) | (_kind[data] == _kind[200]))))
    upper = np.concatenate(([0], np.cumsum(_kind[data] == _kind[65])))
    letters, uppers = letter[found.end] - letter[found.start], upper[found.end] - upper[found.start]
    same = np.concatenate(([False], (found.hash[1:] == found.hash[:-1]) & (passage[1:] == passage[:-1])))
    distinct = np.unique(mix(found.hash + mix(passage.astype(np.uint64) + np.uint64(1))), return_index=True)[1]
    shapes = (np.bincount(passage, np.minimum(length, 40), total) / size / 10, np.bincount(passage, letters == 0, total) / size,
              np.bincount(passage, (uppers == letters) & (letters > 1), total) / size, np.bincount(passage, same, total) / size,
              np.bincount(passage[distinct], minlength=total) / size, np.bincount(passage, letters < length, total) / size,
              np.log1p(n_words) / 4)
    vectors[:, KINDS:] = np.stack(shapes, axis=1)
    return vectors, many


class AttentionModel:
    """Encoder, gated attention and classifier, fitted by Adam on the mean log loss of bags."""

    def __init__(self, seed: int = 3):
        r = np.random.default_rng(seed)
        self.mean, self.scale = np.zeros(FEATURES), np.ones(FEATURES)
        self.p = {"W": r.normal(0, FEATURES ** -0.5, (FEATURES, HIDDEN)), "b": np.zeros(HIDDEN), "V": r.normal(0, 0.3, (HIDDEN, GATE)),
                  "U": r.normal(0, 0.3, (HIDDEN, GATE)), "w": r.normal(0, 0.3, GATE), "c": r.normal(0, 0.3, HIDDEN), "d": np.zeros(1)}

    def _forward(self, x: np.ndarray, bounds: np.ndarray) -> dict:
        p, starts = self.p, bounds[:-1]
        bag = np.repeat(np.arange(len(starts)), np.diff(bounds))
        h = np.tanh(x @ p["W"] + p["b"])
        t, g = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        e = (t * g) @ p["w"]
        e = np.exp(e - np.maximum.reduceat(e, starts)[bag])
        a = e / np.add.reduceat(e, starts)[bag]
        z = np.add.reduceat(a[:, None] * h, starts)
        return {"x": x, "bag": bag, "h": h, "t": t, "g": g, "a": a, "z": z,
                "y": 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["d"], -30, 30)))}

    def _gradients(self, f: dict, label: np.ndarray) -> dict:
        p, bag = self.p, f["bag"]
        dy = (f["y"] - label) / len(label)
        dz = dy[:, None] * p["c"]
        dh = f["a"][:, None] * dz[bag]
        da = (dz[bag] * f["h"]).sum(axis=1)
        de = f["a"] * (da - np.bincount(bag, f["a"] * da, len(label))[bag])
        dt, dg = de[:, None] * p["w"] * f["g"] * (1 - f["t"] ** 2), de[:, None] * p["w"] * f["t"] * f["g"] * (1 - f["g"])
        dh += dt @ p["V"].T + dg @ p["U"].T
        dh *= 1 - f["h"] ** 2
        return {"W": f["x"].T @ dh, "b": dh.sum(axis=0), "V": f["h"].T @ dt, "U": f["h"].T @ dg, "w": (f["t"] * f["g"]).T @ de,
                "c": f["z"].T @ dy, "d": np.array([dy.sum()])}

    def fit(self, x: np.ndarray, many: np.ndarray, label: np.ndarray, epochs: int = 30, batch: int = 64, rate: float = 0.01,
            decay: float = 1e-4, seed: int = 5) -> AttentionModel:
        self.mean, self.scale = x.mean(axis=0), np.maximum(x.std(axis=0), 0.02)
        x = np.clip((x - self.mean) / self.scale, -6, 6)
        first = np.concatenate(([0], np.cumsum(many)))
        r, m, v, step = np.random.default_rng(seed), {}, {}, 0
        for epoch in range(epochs):
            order = r.permutation(len(many))
            for lo in range(0, len(order), batch):
                bags = order[lo:lo + batch]
                rows = np.concatenate([np.arange(first[i], first[i + 1]) for i in bags])
                bounds = np.concatenate(([0], np.cumsum(many[bags])))
                step += 1
                for k, g in self._gradients(self._forward(x[rows], bounds), label[bags]).items():
                    g = g + decay * self.p[k]
                    m[k] = 0.9 * m.get(k, 0) + 0.1 * g
                    v[k] = 0.999 * v.get(k, 0) + 0.001 * g * g
                    pace = rate * (1 - epoch / epochs)
                    self.p[k] = self.p[k] - pace * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
        return self

    def score(self, x: np.ndarray, many: np.ndarray) -> np.ndarray:
        x = np.clip((x - self.mean) / self.scale, -6, 6)
        return self._forward(x, np.concatenate(([0], np.cumsum(many))))["y"]


def passage_share(many: dict[int, int], most: int) -> int:
    """The largest number of passages a document may give so that all give `most` together, one at least; `many` tells how many documents
    have so many passages."""
    low, high = 1, max(many, default=1)
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if sum(min(n, middle) * k for n, k in many.items()) <= most else (low, middle - 1)
    return low


def training_vectors(docs: DataFrame, chosen: DataFrame, max_passages: int = MAX_PASSAGES) -> DataFrame:
    """doc_id, label, x: passage vectors of the documents `chosen` (doc_id, label), one row each; of rows with equal doc_id the smallest text.

    All passages, if there are at most `max_passages`. Else long documents give a sample by a hash of doc_id and place, all the same number, and
    shorter ones all they have, so that there are `max_passages` at most (or one of each document).
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy(F.col("doc_id").cast("long").alias("doc_id"), F.col("label").cast("int").alias("label"))
    rows = materialize(rows.agg(F.min("text").alias("text")), work_dir(spark))
    passages = F.greatest(F.lit(1), F.ceil(n_words(F.col("text")) / PASSAGE)).cast("long")
    share = passage_share({r.n: r["count"] for r in rows.select(passages.alias("n")).groupBy("n").count().collect()}, max_passages)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in text_slices(batch.column(2), 1 << 20):
                x, many = passage_features(data, offsets)
                found = []
                for doc_id, a, n in zip(batch.column(0).slice(first, end - first).to_pylist(), np.cumsum(many) - many, many, strict=True):
                    at = np.arange(n)
                    if n > share:
                        order = mix(mix(np.full(1, doc_id, np.int64).view(np.uint64)) + at.astype(np.uint64))
                        at = np.sort(np.argsort(order, kind="stable")[:share])
                    found.append(x[a + at].astype(np.float32).tobytes())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, end - first), batch.column(1).slice(first, end - first),
                                                  pa.array(found, pa.binary())], names=["doc_id", "label", "x"])

    return rows.select("doc_id", "label", "text").mapInArrow(vectors, "doc_id long, label int, x binary")


def fit_quality(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, max_passages: int = MAX_PASSAGES) -> AttentionModel | float:
    """A model of `labels` (doc_id, label 0 or 1; nulls and ids with two labels are left out) over `docs` (doc_id, text).

    At most `max_train` labelled documents are used, by a hash of their ids, and `max_passages` of their passages. With one class only, or none, the share of label 1 (0.5 without
    labels) stands for a model.
    """
    clean = (labels.where("doc_id IS NOT NULL AND label IN (0, 1)").groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("hi"))
             .where("label = hi").select("doc_id", "label"))
    chosen = clean.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train)
    got = training_vectors(docs, chosen, max_passages).toPandas().sort_values(["doc_id", "x"])
    label = got["label"].to_numpy(float)
    if len(set(label)) < 2:
        return float(label.mean()) if len(label) else 0.5
    bags = [np.frombuffer(x, np.float32).reshape(-1, FEATURES) for x in got["x"]]
    return AttentionModel().fit(np.concatenate(bags).astype(float), np.array([len(b) for b in bags]), label)


def score_quality(docs: DataFrame, model: AttentionModel | float, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score of every row of `docs`: the probability of label 1 from the whole text; a null, empty or blank text gets that of one
    passage without words. Repeated rows get equal scores; other columns are ignored."""

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in text_slices(batch.column(1)):
                y = np.full(end - first, model) if isinstance(model, float) else model.score(*passage_features(data, offsets))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, end - first), pa.array(y, pa.float64())], names=["doc_id", "score"])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(convert, "doc_id long, score double"))


def keep_quality(docs: DataFrame, model: AttentionModel | float, threshold: float, text_col: str = "text") -> DataFrame:
    """The rows of `docs` with a score of at least `threshold`, all columns as they are."""
    column = docs.columns.index(text_col)

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in text_slices(batch.column(column)):
                y = np.full(end - first, model) if isinstance(model, float) else model.score(*passage_features(data, offsets))
                yield batch.slice(first, end - first).filter(pa.array(y >= threshold))

    return docs.mapInArrow(convert, docs.schema)
