"""Token ids in files of independent zstandard frames, with a document index and a seek table at the end.

A file follows the public seekable format of zstandard, so any decoder reads the ids of all its documents in a row:

    frame ...        ids as little-endian unsigned integers of 2 or 4 bytes; whole documents follow each other, and a long one goes on in
                     the next frame; every frame holds its size and its own checksum, and needs no other frame
    skippable frame  the index: doc_id and number of ids of each document, as a compressed Arrow stream
    skippable frame  the seek table: for every frame its compressed and plain size and the lower 32 bits of the XXH64 of its content

A reader takes the two tables from the end, finds the frames that a document lies in by adding up sizes, and decompresses those only.

Tasks write through Spark's text writer, which puts a separator byte after every record: so files go to any store that Spark
writes to, under its commit protocol, and a lost task leaves nothing behind. The separator is the last byte of the seek table; behind
a frame it is the content of a skippable frame of one byte.
"""

from __future__ import annotations

import io
import re
import struct
import zlib
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rideflow.llm.words import text_slices
from rideflow.sources.workdir import materialize, work_dir

# Fixed values of the public format.
SKIPPABLE, SEEK_TABLE, SEEKABLE_MAGIC, WITH_CHECKSUMS = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1, 0x80
_END = bytes([SEEKABLE_MAGIC >> 24])  # the last byte of a file, and so the separator of records
_PAD = struct.pack("<II", SKIPPABLE, len(_END))

FRAME_BYTES = 1 << 18
FRAMES_PER_FILE = 256
BATCH_CHARS = 1 << 20
SLICE_BYTES = 8 << 20
MOST_KEPT = 1 << 19
LONG = 256
FILE_ORDER = ("part", "chunk")


@lru_cache(maxsize=4)
def _tokenizer(model: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_str(model)


_letter_or_digit = np.zeros(256, bool)
_letter_or_digit[0x30:0x3A] = _letter_or_digit[0x41:0x5B] = _letter_or_digit[0x61:0x7B] = True
_mark = np.zeros(256, bool)
_mark[0x21:0x7F] = ~_letter_or_digit[0x21:0x7F]
_mark[0x27] = False  # an apostrophe can go with the letters behind it


def word_cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte positions that cut some texts into pieces which tokens do not reach over, the starts of the texts included.

    A cut is in front of a blank or line feed that follows a character which is surely no white space (a visible ASCII one, or one of two bytes whose
    first is not C2), and between an ASCII letter or digit and a punctuation mark. The words of byte-level BPE end there whatever follows."""
    cut = np.zeros(len(data) + 1, bool)
    if len(data) > 1:
        before = data[:-1]
        solid = (before > 0x20) & (before < 0x7F)
        solid[1:] |= (before[1:] >= 0x80) & (data[:-2] > 0xC2) & (data[:-2] < 0xE0)
        cut[1:-1] = solid & ((data[1:] == 0x20) | (data[1:] == 0x0A)) | _letter_or_digit[before] & _mark[data[1:]]
    cut[offsets] = True
    cut[-1] = False
    return np.flatnonzero(cut)


@lru_cache(maxsize=1)
def _encoder(model: str, words: bool) -> Encoder:
    """The encoder of this worker, with what it has learned from earlier tasks."""
    return Encoder(model, words)


class Encoder:
    """Ids of texts by a tokenizer. With `words`, texts are cut by `word_cuts` and a distinct piece is encoded once as long as it is
    kept: about MOST_KEPT pieces are, and those before them until as many others came up without it. Pieces over LONG characters are not kept."""

    def __init__(self, model: str, words: bool = True):
        self.tokenizer, self.words = _tokenizer(model), words
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        self.kept: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _bounds(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The cuts that lie in no added token; the tokenizer looks for those first."""
        bounds, raw = word_cuts(data, offsets), data.tobytes()
        inside = np.zeros(len(data) + 1, bool)
        for token in self.added:
            starts = np.fromiter((m.start() for m in re.finditer(b"(?=" + re.escape(token) + b")", raw)), np.int64)
            for k in range(1, len(token) if len(starts) else 0):
                inside[starts + k] = True
        inside[offsets] = False
        return bounds[~inside[bounds]]

    def _plain(self, texts: list[str]) -> Iterator[bytes]:
        low = 0
        while low < len(texts):
            high, size = low, 0
            while high < len(texts) and (high == low or size + len(texts[high]) <= BATCH_CHARS):
                size += len(texts[high])
                high += 1
            for one in self.tokenizer.encode_batch_fast(texts[low:high], add_special_tokens=False):
                yield array("I", one.ids).tobytes()
            low = high

    def __call__(self, column: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text of a string column; null counts as empty."""
        for _, _, data, offsets in text_slices(column, SLICE_BYTES):
            bounds = self._bounds(data, offsets) if self.words else np.unique(offsets[:-1][offsets[:-1] < offsets[-1]])
            ends = np.append(bounds[1:], offsets[-1:]) if len(bounds) else bounds
            cut = pa.LargeStringArray.from_buffers(len(bounds), pa.py_buffer(np.append(bounds, ends[-1:]).astype(np.int64)), pa.py_buffer(data))
            distinct = cut.dictionary_encode()
            texts = distinct.dictionary.to_pylist()
            known = [self.kept.get(t) or self.older.get(t) for t in texts]
            encoded = self._plain([t for t, ids in zip(texts, known, strict=True) if ids is None])
            known = [next(encoded) if ids is None else ids for ids in known]
            if len(self.kept) > MOST_KEPT:
                self.kept, self.older = {}, self.kept
            self.kept.update((t, ids) for t, ids in zip(texts, known, strict=True) if len(t) <= LONG)
            flat = np.frombuffer(b"".join(known), np.uint32)
            length = np.fromiter(map(len, known), np.int64, len(known)) // 4
            first = np.cumsum(length) - length
            code = distinct.indices.to_numpy()
            upto = np.concatenate(([0], np.cumsum(length[code])))
            out = flat[np.arange(upto[-1]) + np.repeat(first[code] - upto[:-1], length[code])]
            at = upto[np.searchsorted(bounds, offsets)]
            yield from (out[x:y] for x, y in zip(at[:-1], at[1:], strict=True))


class _File:
    """One file in the making: takes the ids of documents and gives the finished records."""

    def __init__(self, width: int, frame_bytes: int, frames: int, level: int):
        self.dtype, self.frame_bytes, self.frames = np.dtype(f"<u{width}"), frame_bytes, frames
        self.packer = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True)
        self.held = bytearray()
        self.table: list[tuple[int, int, int]] = []
        self.doc_ids: list[int | None] = []
        self.counts: list[int] = []

    def takes(self, n: int) -> bool:
        """Whether a document of n ids fits; an empty file takes any."""
        ahead = (len(self.held) + n * self.dtype.itemsize) / self.frame_bytes
        return not self.doc_ids or len(self.table) + ahead <= self.frames

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[bytes]:
        self.doc_ids.append(doc_id)
        self.counts.append(len(ids))
        data = ids.astype(self.dtype).tobytes()
        # a document longer than a whole file gets longer frames
        size = max(self.frame_bytes, -(-len(data) // self.frames)) if len(self.doc_ids) == 1 else self.frame_bytes
        self.held += data
        while len(self.held) >= size:
            yield self._frame(size)

    def _frame(self, size: int) -> bytes:
        plain = bytes(self.held[:size])
        del self.held[:size]
        packed = self.packer.compress(plain) + _PAD
        self.table.append((len(packed) + len(_END), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF))
        return packed

    def close(self, records: int | None) -> Iterator[bytes]:
        """What is left of the file; with `records`, filled up to that many records in all."""
        if self.held:
            yield self._frame(len(self.held))
        for _ in range(0 if records is None else records - 2 - len(self.table)):
            self.table.append((len(_PAD) + len(_END), 0, xxhash.xxh64_intdigest(b"") & 0xFFFFFFFF))
            yield _PAD
        index = pa.record_batch({"doc_id": pa.array(self.doc_ids, pa.int64()), "n_tokens": pa.array(self.counts, pa.int64())})
        index = index.replace_schema_metadata({"width": str(self.dtype.itemsize)})
        sink = io.BytesIO()
        with pa.ipc.new_stream(sink, index.schema) as stream:
            stream.write_batch(index)
        packed = self.packer.compress(sink.getvalue())
        packed = struct.pack("<II", SKIPPABLE, len(packed) + len(_END)) + packed
        self.table.append((len(packed) + len(_END), 0, xxhash.xxh64_intdigest(b"") & 0xFFFFFFFF))
        yield packed
        entries = b"".join(struct.pack("<III", *entry) for entry in self.table)
        footer = struct.pack("<IBI", len(self.table), WITH_CHECKSUMS, SEEKABLE_MAGIC)
        yield (struct.pack("<II", SEEK_TABLE, len(entries) + len(footer)) + entries + footer)[:-len(_END)]


def token_records(docs: Iterable[tuple[int | None, np.ndarray]], width: int, frame_bytes: int = FRAME_BYTES, frames: int = FRAMES_PER_FILE,
                  level: int = 3) -> Iterator[bytes]:
    """The records of the files that hold `docs`; each file but the last has `frames` + 2."""
    file = None
    for doc_id, ids in docs:
        if file is not None and not file.takes(len(ids)):
            yield from file.close(frames + 2)
            file = None
        file = file or _File(width, frame_bytes, frames, level)
        yield from file.add(doc_id, ids)
    if file is not None:
        yield from file.close(None)


def write_token_files(docs: DataFrame, path: str, model: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text",
                      frame_bytes: int = FRAME_BYTES, frames: int = FRAMES_PER_FILE, words: bool = True) -> None:
    """Encode every text (null counts as empty), append `end_id`, and write the files in ascending order of the ids, null ids last.

    `model` is the JSON text of a tokenizer, which travels to the tasks. Rows are dealt by ranges and sorted, so task k writes what comes
    before task k + 1. Rows with the same id are ordered by a hash of their texts and then by their place in the input, so that many of them spread
    over tasks as well. Every row is written, repeated or not; other columns are ignored. No rows give a folder without documents.
    `words` must be False for a tokenizer whose tokens reach over white space that follows a word."""
    width = 2 if _tokenizer(model).get_vocab_size() <= 1 << 16 and end_id < 1 << 16 else 4
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    slim = slim.withColumn("tie", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    order = [F.asc_nulls_last("doc_id"), F.col("tie"), F.col("row")]
    dealt = slim.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for every core
        ended = np.array([end_id], np.uint32)

        def documents() -> Iterator[tuple[int | None, np.ndarray]]:
            encoder = _encoder(model, words)
            for batch in batches:
                for doc_id, ids in zip(batch.column(0).to_pylist(), encoder(batch.column(1)), strict=True):
                    yield doc_id, np.concatenate((ids, ended))

        for record in token_records(documents(), width, frame_bytes, frames):
            yield pa.record_batch({"record": pa.array([record], pa.binary())})

    records = dealt.mapInArrow(write, "record binary").select(F.col("record").cast("string").alias("record"))
    (records.write.mode("overwrite").option("lineSep", _END.decode("latin-1")).option("encoding", "ISO-8859-1")
     .option("maxRecordsPerFile", frames + 2).text(path))


class TokenFile:
    """A reader of one file, given as bytes. Only frames that are asked for are decompressed, and their checksums are compared."""

    def __init__(self, data: bytes | memoryview):
        self.data = memoryview(data)
        try:
            n, flags, magic = struct.unpack("<IBI", self.data[-9:])
            if magic != SEEKABLE_MAGIC or flags != WITH_CHECKSUMS:
                raise ValueError("no seek table with checksums at the end")
            begin = len(self.data) - 9 - 12 * n
            if struct.unpack("<II", self.data[begin - 8:begin]) != (SEEK_TABLE, 12 * n + 9):
                raise ValueError("the seek table does not start where it should")
            table = np.frombuffer(self.data[begin:-9], "<u4").reshape(n, 3)
            self.at = np.concatenate(([0], np.cumsum(table[:, 0], dtype=np.int64)))
            self.plain = np.concatenate(([0], np.cumsum(table[:, 1], dtype=np.int64)))
            self.sums = table[:, 2]
            if self.at[-1] != begin - 8:
                raise ValueError("the frames do not fill the file")
            packed = self.data[self.at[-2] + 8:self.at[-1] - len(_END)]
            with pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(packed)) as stream:
                index = stream.read_all()
        except (struct.error, IndexError, zstandard.ZstdError, pa.ArrowInvalid) as error:
            raise ValueError(f"not a file of token ids: {error}") from error
        self.dtype = np.dtype(f"<u{int(index.schema.metadata[b'width'])}")
        self.doc_ids = index.column("doc_id").to_pylist()
        self.starts = np.concatenate(([0], np.cumsum(index.column("n_tokens").to_numpy(), dtype=np.int64)))
        self._kept: tuple[int, bytes] = (-1, b"")
        self.opened = 0

    def _frame(self, k: int) -> bytes:
        if self._kept[0] != k:
            try:
                plain = zstandard.ZstdDecompressor().decompress(self.data[self.at[k]:self.at[k + 1]], allow_extra_data=True)
            except zstandard.ZstdError as error:
                raise ValueError(f"frame {k} is damaged: {error}") from error
            if xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF != self.sums[k] or len(plain) != self.plain[k + 1] - self.plain[k]:
                raise ValueError(f"frame {k} is damaged: its checksum is wrong")
            self._kept = (k, plain)
            self.opened += 1
        return self._kept[1]

    def parts(self, i: int) -> Iterator[np.ndarray]:
        """The ids of document i, frame by frame."""
        low, high = (int(x) * self.dtype.itemsize for x in self.starts[i:i + 2])
        k = int(np.searchsorted(self.plain, low, "right")) - 1
        while low < high:
            upto = min(high, int(self.plain[k + 1]))
            if upto > low:
                yield np.frombuffer(self._frame(k), np.uint8)[low - self.plain[k]:upto - self.plain[k]].view(self.dtype)
                low = upto
            k += 1


def _files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    found = spark.read.format("binaryFile").load(path).where("length > 0")
    return found.select("path", *[F.regexp_extract("path", pattern, 1).cast("int").alias(c) for c, pattern in
                                  zip(FILE_ORDER, (r"/part-(\d+)-[^/]*$", r"-c(\d+)\.[^/]*$"), strict=True)], "content")


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """One row for each document of the files under `path`, all read and checked: doc_id, path, nth (its place in the file), start (ids of
    all documents before it, over all files), n_tokens, ids_crc32 (of its ids as little-endian unsigned 32-bit integers)."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                file = TokenFile(batch.column(3)[row].as_buffer())
                sums = []
                for i in range(len(file.doc_ids)):
                    crc = 0
                    for part in file.parts(i):
                        crc = zlib.crc32(part.astype("<u4"), crc)
                    sums.append(crc)
                n = len(sums)
                yield pa.record_batch({
                    **{c: pa.array([batch.column(k)[row].as_py()] * n, kind) for k, (c, kind) in
                       enumerate((("path", pa.string()), ("part", pa.int32()), ("chunk", pa.int32())))},
                    "nth": pa.array(range(n), pa.int64()), "doc_id": pa.array(file.doc_ids, pa.int64()), "first": pa.array(file.starts[:-1], pa.int64()),
                    "n_tokens": pa.array(np.diff(file.starts), pa.int64()), "ids_crc32": pa.array(sums, pa.int64())})

    schema = "path string, part int, chunk int, nth long, doc_id long, first long, n_tokens long, ids_crc32 long"
    read = materialize(_files(spark, path).mapInArrow(digest, schema), work_dir(spark))
    # one row a file
    sums = read.groupBy(*FILE_ORDER).agg(F.sum("n_tokens").alias("n"))
    above = Window.orderBy(*FILE_ORDER).rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select(*FILE_ORDER, F.coalesce(F.sum("n").over(above), F.lit(0)).alias("before"))
    return read.join(before, list(FILE_ORDER)).select("doc_id", "path", "nth", (F.col("before") + F.col("first")).alias("start"), "n_tokens", "ids_crc32")


def read_token_ids(spark: SparkSession, path: str | list[str], doc_ids: list[int]) -> DataFrame:
    """doc_id, ids, n_opened (frames decompressed so far in its file) of the documents with the given ids, which the caller holds; only
    frames that hold them are decompressed. `path` may be the list of files that an index names for them."""
    asked = set(doc_ids)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                file = TokenFile(content.as_buffer())
                for i, doc_id in enumerate(file.doc_ids):
                    if doc_id in asked:
                        ids = np.concatenate([np.zeros(0, np.int64), *file.parts(i)]).astype(np.int64)
                        yield pa.record_batch({"doc_id": pa.array([doc_id], pa.int64()), "ids": pa.array([ids], pa.list_(pa.int64())),
                                               "n_opened": pa.array([file.opened], pa.int64())})

    return _files(spark, path).select("content").mapInArrow(find, "doc_id long, ids array<long>, n_opened long")
