"""Language by rank-order profiles of character n-grams.

A profile lists the `PROFILE` most frequent n-grams (one to three letters, with the blanks around words) of all training texts of a
language. A document's own list is compared with each profile by out-of-place distance: the sum, over its n-grams, of how far
their ranks are apart, or the largest distance for one that the profile lacks. The nearest profile names the language.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PROFILE = 300
NONE = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def letter_codes(text: str) -> np.ndarray:
    """Code points of the lower-cased letters; each run of other characters is one 0, and one 0 is at both ends."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    points = np.concatenate(([0], np.where(_letters()[points], points, 0), [0]))
    return points[np.concatenate(([True], (points[1:] != 0) | (points[:-1] != 0)))].astype(np.uint64)


def ngrams(codes: np.ndarray) -> np.ndarray:
    """N-grams of one to three letters as numbers, 21 bits a letter; no n-gram reaches over a blank."""
    one = codes[codes != 0]
    two = (codes[:-1] << np.uint64(21) | codes[1:]) | np.uint64(1 << 62)
    three = ((codes[:-2] << np.uint64(42) | codes[1:-1] << np.uint64(21) | codes[2:]) | np.uint64(1 << 63))[codes[1:-1] != 0]
    return np.concatenate((one, two, three))


def ranked(grams: np.ndarray, n: int = PROFILE) -> np.ndarray:
    """The n most frequent n-grams, most frequent first, equal counts by number."""
    found, counts = np.unique(grams, return_counts=True)
    return found[np.argsort(-counts, kind="stable")[:n]]


def learn_profiles(docs: DataFrame, n: int = PROFILE) -> dict[str, list[int]]:
    """Profiles of the languages of `docs` (lang, text); rows without a language or without letters teach nothing.

    N-grams are counted in the tasks and added up by language and n-gram; the first n of each language come to the driver.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            frame = batch.to_pandas()
            for lang, part in frame.groupby("lang"):
                texts, held, size = part["text"].tolist(), [], 0
                for i, text in enumerate(texts):
                    held.append(ngrams(letter_codes(text)))
                    size += len(held[-1])
                    if size > 4_000_000 or i == len(texts) - 1:
                        found, counts = np.unique(np.concatenate(held), return_counts=True)
                        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(found), pa.string()), pa.array(found.view(np.int64)),
                                                          pa.array(counts, pa.int64())], names=["lang", "gram", "n"])
                        held, size = [], 0

    rows = docs.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text").mapInArrow(count, "lang string, gram long, n long")
    summed = rows.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    # the sign bit tells longer n-grams from shorter ones: as in the tasks, they come last among equals
    order = Window.partitionBy("lang").orderBy(F.desc("n"), F.col("gram").bitwiseXOR(F.lit(-(1 << 63))))
    best = summed.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
    profiles: dict[str, list[int]] = {}
    for row in best.orderBy("lang", "rank").collect():
        profiles.setdefault(row.lang, []).append(row.gram)
    return profiles


class Profiles:
    """The profiles as one table from n-gram to its rank in every language."""

    def __init__(self, profiles: dict[str, list[int]], n: int = PROFILE):
        self.n, self.langs = n, sorted(profiles)
        lists = [np.array(profiles[lang], np.int64).view(np.uint64) for lang in self.langs]
        self.grams = np.unique(np.concatenate(lists)) if lists else np.zeros(0, np.uint64)
        self.ranks = np.full((len(lists), len(self.grams)), -1, np.int64)
        for row, grams in zip(self.ranks, lists, strict=True):
            row[np.searchsorted(self.grams, grams)] = np.arange(len(grams))

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, closeness from 0 to 1); equal distances go to the first language by name."""
        codes = letter_codes(text or "")
        if not self.langs or len(codes) < 2:
            return NONE, 0.0
        own = ranked(ngrams(codes), self.n)
        at = np.minimum(np.searchsorted(self.grams, own), len(self.grams) - 1)
        known = self.ranks[:, at]
        apart = np.where((known >= 0) & (self.grams[at] == own), np.minimum(np.abs(known - np.arange(len(own))), self.n), self.n)
        distance = apart.sum(axis=1)
        best = int(np.argmin(distance))
        return self.langs[best], float(1 - distance[best] / (self.n * len(own)))


def identify_language(docs: DataFrame, profiles: dict[str, list[int]], id_col: str = "doc_id", text_col: str = "text", n: int = PROFILE) -> DataFrame:
    """doc_id, lang_pred, score of every row of `docs`, from the whole text. A text that is null or has no letter, or an empty set of
    profiles, gives "und" and 0. Repeated rows get equal results; other columns are ignored."""

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Profiles(profiles, n)
        for batch in batches:
            got = [table.predict(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())],
                                             names=["doc_id", "lang_pred", "score"])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(convert, "doc_id long, lang_pred string, score double"))


def keep_language(docs: DataFrame, profiles: dict[str, list[int]], least: float, text_col: str = "text", n: int = PROFILE) -> DataFrame:
    """The rows of `docs` whose text has letters and is at least `least` close to a profile, all columns as they are."""
    column = docs.columns.index(text_col)

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Profiles(profiles, n)
        for batch in batches:
            got = [table.predict(t.as_py()) for t in batch.column(column)]
            yield batch.filter(pa.array([lang != NONE and score >= least for lang, score in got], pa.bool_()))

    return docs.mapInArrow(convert, docs.schema)
