"""Filter audit, token files and source divergence against plain versions of themselves, and their small cases."""

import glob
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rideflow.llm import audit_sql, queries
from rideflow.llm.divergence import SIDE, pyramid, source_divergence, terms_of, walk
from rideflow.llm.filter_audit import audit_filters, count_paths, count_repeats, orders
from rideflow.llm.token_files import Encoder, TokenFile, read_token_ids, token_digests, token_records, word_cuts, write_token_files
from tests.compare import compare, duck

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string"


# --- filter audit --------------------------------------------------------------------------------


def test_paths_are_those_of_all_orders():
    for before in ([], [(0, 2)], [(3, 0), (1, 2)]):
        listed = list(orders(4, before))
        assert listed == [o for o in itertools.permutations(range(4)) if all(o.index(a) < o.index(b) for a, b in before)]
        reach, leave = count_paths(4, before)
        for state in range(16):
            inside = [f for f in range(4) if state >> f & 1]
            through = [o for o in listed if sorted(o[:len(inside)]) == inside]
            assert reach[state] * leave[state] == len(through)
    assert count_paths(3)[0][-1] == 6


def _plain_audit(rows, names, marks, listed):
    """rows: (part, {failed names}, {marks}); returns the operator's rows as a set of tuples."""
    out, total = [], Counter()
    for part, order in itertools.product(sorted({r[0] for r in rows}), listed):
        left = [r for r in rows if r[0] == part]
        gone = []
        for step, name in enumerate(order, 1):
            removed = [r for r in left if name in r[1]]
            left = [r for r in left if name not in r[1]]
            total[part, name] += len(removed)
            out.append((part, "".join(order), step, name, len(left), len(removed), sum(name in r[1] for r in gone),
                        sum(r[0] == part and r[1] == {name} for r in rows), *[sum(m in r[2] for r in removed) for m in marks]))
            gone += removed
    return {(*r, total[r[0], r[3]]) for r in out}


@pytest.mark.parametrize("before", [[], [("q", "p")]])
def test_audit_recounted(spark, before):
    rng = random.Random(5)
    rows = [(rng.choice(["x", "y", ""]), {f for f in "pqr" if rng.random() < 0.4}, {m for m in "uv" if rng.random() < 0.3}) for _ in range(300)]
    # columns named like the operator's own must not disturb it
    data = [(part or None, *[f in failed for f in "pqr"], *[m in marks or None for m in "uv"], 7, 8, 9) for part, failed, marks in rows]
    frame = spark.createDataFrame(data, "part string, p boolean, q boolean, r boolean, u boolean, v boolean, state int, n int, failed int")
    got = audit_filters(frame, {f: F.col(f) for f in "pqr"}, F.col("part"), {m: F.col(m) for m in "uv"}, before=before)
    listed = [o for o in itertools.permutations("pqr") if all(o.index(a) < o.index(b) for a, b in before)]
    found = [tuple(r) for r in got.collect()]
    assert set(found) == _plain_audit(rows, "pqr", "uv", listed) and len(found) == 3 * len(listed) * 3
    assert audit_filters(frame.limit(0), {"p": F.col("p")}, F.col("part"), {}).collect() == []
    with pytest.raises(ValueError):
        audit_filters(frame, {str(i): F.col("p") for i in range(9)}, F.col("part"), {})


def test_repeats_are_told_by_smaller_ids(spark):
    rows = [(1, "a", "x"), (2, "a", "y"), (2, "a", "y"), (3, "b", "x"), (3, "b", "x"), (None, "a", "x"), (None, "c", "x"), (4, "c", "x"), (5, None, "x"), (6, None, "x")]
    got = count_repeats(spark.createDataFrame(rows, "id long, k string, c string"), "id", "k", ["c"])
    assert {(r.c, r.repeat): r.n for r in got.collect()} == {("x", False): 7, ("y", True): 2, ("x", True): 1}


def test_op11_matches_sql_with_odd_rows(spark, tmp_path):
    long = " ".join(f"w{i}" for i in range(40_000))
    texts = [None, "", " \t\n", "A" * 10, "é" * 40 + "A", "a # b", " ".join(["x"] * 300), long, long, "\x0b\x0c a b \x1f"]
    rows = [(i, t, lang, "s", 1) for i, (t, lang) in enumerate(itertools.product(texts, ["en", None, ""]))] + [(None, "a # b", "en", "s", 1), (3, "", "en", "s", 2)]
    spark.createDataFrame(rows, SCHEMA + ", part int").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(0, 1, 0), (0, 0, 1), (5, 1, 1), (None, 1, 1), (7, None, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").coalesce(1).write.parquet(f"{tmp_path}/labels.parquet")
    import duckdb

    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    # SQL compares a null id as unknown, which does not fail either
    kind, n, problems = compare(spark, con, "op11", queries.op11_filter_audit, audit_sql.FILTER_AUDIT, str(tmp_path))
    assert not problems and n == 2 * 600
    assert queries.op11_filter_audit(spark, SF).where("kept + removed + redundant < 0 OR removed < greatest(good_lost, toxic_lost)").count() == 0


# --- token files ---------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def model():
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        return file.read()


def test_encoding_by_words_changes_nothing(model):
    rng = random.Random(3)
    atoms = [" ", "  ", "\n", "\t ", "\u00a0", "\u3000", "\u2003", "\u0085", "it's", "we'll", "word", "42", "?!", "\u00e9", "\u6f22\u5b57", "\U0001f642",
             "\x1f", "\x7f", "a" * 50, " x", "<|endoftext|>", ",", "'", "...", "_", "a,", "I'm.", "-"]
    texts = ["", " ", "one", None, *["".join(rng.choice(atoms) for _ in range(rng.randrange(1, 200))) for _ in range(2000)],
             " ".join(rng.choice(atoms) for _ in range(600_000)), "", "x" * 300_000, ""]
    whole = [w.ids for w in Tokenizer.from_str(model).encode_batch([t or "" for t in texts], add_special_tokens=False)]
    for words in (True, False):
        got = list(Encoder(model, words)(pa.array(texts)))
        assert len(got) == len(texts) and all(g.tolist() == w for g, w in zip(got, whole))
    assert list(Encoder(model)(pa.array([], pa.string()))) == [] and [g.tolist() for g in Encoder(model)(pa.array(["", None]))] == [[], []]


def test_cuts_are_behind_what_is_no_white_space():
    data = "a b\u00e9 c\u00a0 d\u3000 e\t f\n\ng h".encode()
    cuts = word_cuts(np.frombuffer(data, np.uint8), np.array([0, 2, len(data)]))
    assert [data[a:b].decode() for a, b in zip(cuts, [*cuts[1:], None])] == ["a", " ", "b\u00e9", " c\u00a0 d\u3000 e\t f", "\n\ng", " h"]
    data = "it's 3.5, \u00d7, \u00e9, a_b".encode()
    cuts = word_cuts(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    assert [data[a:b].decode() for a, b in zip(cuts, [*cuts[1:], None])] == ["it's", " 3", ".5", ",", " \u00d7,", " \u00e9,", " a", "_b"]


def _docs(n, seed, longest=400):
    rng = np.random.default_rng(seed)
    return [(i, rng.integers(0, 50_000, rng.integers(0, longest)).astype(np.uint32)) for i in range(n)]


def _split(records, per_file):
    """The files that Spark's writer makes of the records."""
    return [b"".join(r + b"\x8f" for r in records[k:k + per_file]) for k in range(0, len(records), per_file)]


@pytest.mark.parametrize("width", [2, 4])
def test_files_hold_what_was_written(width):
    docs = _docs(300, 1) + [(None, np.arange(9, dtype=np.uint32)), (5, np.zeros(0, np.uint32)), (6, np.arange(50_000, dtype=np.uint32)), (7, np.ones(3, np.uint32))]
    files = [TokenFile(data) for data in _split(list(token_records(docs, width, 512, 16)), 18)]
    assert len(files) > 5
    back = [(f.doc_ids[i], np.concatenate([np.zeros(0, np.uint32), *f.parts(i)]).tolist()) for f in files for i in range(len(f.doc_ids))]
    assert back == [(i, ids.tolist()) for i, ids in docs]


def test_any_decoder_reads_a_file_and_a_reader_opens_few_frames():
    docs = _docs(200, 2)
    (data,) = _split(list(token_records(docs, 2, 1024, 1 << 12)), 1 << 13)
    with zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True) as stream:
        assert stream.read() == np.concatenate([ids for _, ids in docs]).astype("<u2").tobytes()
    file = TokenFile(data)
    assert np.concatenate(list(file.parts(150))).tolist() == docs[150][1].tolist()
    assert 1 <= file.opened <= 2 and len(file.sums) > 50


def test_damage_is_noticed():
    (data,) = _split(list(token_records(_docs(50, 4), 2, 1024, 1 << 12)), 1 << 13)

    def read(changed):
        file = TokenFile(changed)
        return [list(file.parts(i)) for i in range(len(file.doc_ids))]

    read(data)
    for at in (40, 700, len(data) - 9 - 12 * 3 + 8, len(data) - 1, len(data) - 9):
        with pytest.raises(ValueError):
            read(data[:at] + bytes([data[at] ^ 1]) + data[at + 1:])
    for cut in (0, 5, len(data) // 2):
        with pytest.raises(ValueError):
            read(data[:cut])


def test_token_files_on_spark(spark, model, tmp_path):
    words = " ".join(f"w{i}" for i in range(60_000))
    rows = [(7, "b", 1), (3, None, 1), (3, "", 1), (-4, "it's", 1), (None, "no id", 1), (8, words, 1), *[(9, "same text", 1)] * 500, (10, "<|endoftext|>", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, record int").repartition(4)
    write_token_files(docs, str(tmp_path / "t"), model, frame_bytes=4096, frames=8)
    tokenizer = Tokenizer.from_str(model)
    ids = {t: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for t in {r[1] for r in rows}}
    want, start = [], 0
    for doc_id, text, _ in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, len(ids[r[1]]))):
        own = np.array(ids[text], "<u4")
        want.append((doc_id, start, len(own), zlib.crc32(own.tobytes())))
        start += len(own)
    digests = token_digests(spark, str(tmp_path / "t"))
    got = sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in digests.collect()), key=lambda r: r[1])
    assert got == want and digests.select("path").distinct().count() > 2
    assert {(r.doc_id, tuple(r.ids)) for r in read_token_ids(spark, str(tmp_path / "t"), [8, 10, 99]).collect()} == {(8, tuple(ids[words])), (10, tuple(ids["<|endoftext|>"]))}
    held = [r.path for r in digests.where("doc_id = 7").select("path").distinct().collect()]
    assert [(r.ids, r.n_opened) for r in read_token_ids(spark, held, [7]).collect()] == [(ids["b"], 1)]
    write_token_files(docs.limit(0), str(tmp_path / "none"), model)
    assert token_digests(spark, str(tmp_path / "none")).collect() == []


def test_op12_recounted(spark, con, model):
    rows = con.execute("SELECT doc_id, coalesce(text, '') FROM documents ORDER BY doc_id").fetchall()
    found = Tokenizer.from_str(model).encode_batch([t for _, t in rows], add_special_tokens=False)
    want, start = [], 0
    for (doc_id, _), one in zip(rows, found):
        own = np.array([*one.ids, 0], "<u4")
        want.append((doc_id, start, len(own), zlib.crc32(own.tobytes())))
        start += len(own)
    assert sorted(tuple(r) for r in queries.op12_token_files(spark, SF).collect()) == want


# --- source divergence ---------------------------------------------------------------------------


def test_terms_are_those_of_the_pattern():
    texts = ["", "Ab1cD é-ÉB", "", "x", "Y", "\x7f[z]{q}", "ÄÖ 漢字a", "", "end"]
    data = [t.encode() for t in texts]
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in data])))
    place, terms = terms_of(np.frombuffer(b"".join(data), np.uint8), offsets)
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    want = [(i, w.translate(lower)) for i, t in enumerate(texts) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t)]
    assert list(zip(place.tolist(), terms.to_pylist())) == want


@pytest.mark.parametrize("same", [True, False])
def test_walk_sees_every_pair_with_a_count(same):
    rng = np.random.default_rng(0)
    n, m = (200, 200) if same else (256, 37)
    x, y = (np.unique(rng.integers(0, [rows, SIDE], (400, 2)), axis=0) for rows in (n, m))
    y = x if same else y
    got = [np.concatenate(c) for c in zip(*walk(pyramid(*x.T), pyramid(*y.T), n, m, same))]
    filled = [np.zeros((SIDE, SIDE), bool) for _ in range(2)]
    for f, cells in zip(filled, (x, y)):
        f[cells[:, 0], cells[:, 1]] = True
    want = {(a, b, c) for a in range(n) for b in range(a + 1 if same else 0, m) for c in np.flatnonzero(filled[0][a] | filled[1][b])}
    assert set(zip(*(g.tolist() for g in got))) == want and len(got[0]) == len(want)
    empty = pyramid(np.zeros(0, int), np.zeros(0, int))
    assert sum(len(a) for a, _, _ in walk(empty, empty, n, m, same)) == 0


def _plain_divergence(rows, least, top):
    counts, held, groups = defaultdict(Counter), defaultdict(Counter), set()
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        found = [t.translate(lower) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        groups.add((lang, source))
        counts[lang, source].update(found)
        held[lang].update(set(found))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in held[lang].items() if n >= least]
        sources = [s for g, s in groups if g == lang]

        def p(count):
            size = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 5) // (size + 5 * len(kept)) for t in kept}

        own = {s: p(counts[lang, s]) for s in sources}
        q = p(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pair = sorted((-sum(abs(own[s][t] - own[o][t]) for t in kept), o.encode()) for o in sources if o != s)
            term = sorted((q[t] - own[s][t], t.encode()) for t in kept if counts[lang, s][t] and own[s][t] > q[t])[:top]
            out += [(lang, s, part, o.decode(), -v, i) for part, some in (("pair", pair), ("term", term)) for i, (v, o) in enumerate(some, 1)]
    return sorted(out)


def test_divergence_recounted_over_many_tiles(spark):
    """More groups and more terms than one tile holds."""
    rng = random.Random(11)
    vocabulary = [f"{a}{b}" for a in "aąbcdefghi" for b in ("".join(x) for x in itertools.product("klmnopqrs", repeat=2))]
    rows = []
    for i in range(900):
        source = f"s{i % 290}" if i % 3 else "hot"
        words = [rng.choice(vocabulary[: 30 + 3 * (i % 260)]) for _ in range(rng.randrange(0, 60))]
        rows.append((i, " ".join(words) + " SAME same", "de" if i % 50 else "en", source))
    rows += [(None, None, None, None), (1, "", None, "z"), (1, "a b", None, None), (2, "x" * 100_000, "en", None), (3, "only here", "xx", "one"), (4, "", "yy", "a"), (4, None, "yy", "b")]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("term", F.lit(1)).withColumn("p", F.lit("x")).repartition(3)
    got = sorted(tuple(r) for r in source_divergence(docs, least_docs=2, top=5).collect())
    want = _plain_divergence(rows, 2, 5)
    assert len({r[1] for r in want if r[0] == "de"}) > SIDE
    assert got == want
    assert ("yy", "a", "pair", "b", 0, 1) in got
    assert source_divergence(docs.limit(0)).collect() == []


def test_op13_matches_sql(spark, con):
    kind, n, problems = compare(spark, con, "op13", queries.op13_source_divergence, audit_sql.SOURCE_DIVERGENCE, SF)
    assert not problems and n > 0


def test_counts_beyond_a_long_are_exact(spark):
    from rideflow.llm.divergence import _probability

    n, total = 7 * 10**12 + 1, 9 * 10**12 + 3
    assert spark.sql(f"SELECT {n}L AS n, {total}L AS total").select(_probability("n", "total").alias("p")).first().p == 1 + 10**9 * (n + 5) // total


def test_files_are_plain_files_in_order(spark, model, tmp_path):
    docs = spark.range(0, 2000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text")).repartition(7)
    write_token_files(docs, str(tmp_path / "t"), model, frame_bytes=1024, frames=2)
    files = sorted(glob.glob(str(tmp_path / "t" / "part-*")))
    ids = [i for f in files for i in TokenFile(open(f, "rb").read()).doc_ids]
    assert ids == list(range(2000)) and len(files) > 4
