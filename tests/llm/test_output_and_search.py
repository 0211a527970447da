"""Token files, hard negatives and ranked search against plain versions."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ideaweave.llm import lexical, negatives, tokens
from ideaweave.llm.common import materialise, shared_path

from .test_text_operators import SCHEMA, key, texts

WORD_BPE, BYTE_BPE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")


# -- token files -------------------------------------------------------------------------------

def test_packing_round_trip():
    rng = np.random.default_rng(0)
    assert [tokens.bits_for(n) for n in (1, 2, 3, 49408, 65536, 65537)] == [1, 1, 2, 16, 16, 17]
    for bits in (1, 3, 7, 11, 16, 17, 31, 32):
        for n in (0, 1, 63, 64, 65, 9000):
            x = rng.integers(0, 1 << bits, n, dtype=np.uint64)
            data = tokens.pack(x, bits)
            assert len(data) == -(-n // 64) * bits * 8 and (tokens.unpack(data, bits, n) == x).all()


def test_shard_random_access():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 15, 30_000).astype(np.uint32)
    s = tokens.Shard(tokens.shard_bytes([None, 5, 7, -2], [10, 20_000, 0, 9990], x, 15))
    assert s.doc_ids == [None, 5, 7, -2] and len(s.payload) < 15 * 30_000 // 8 + 15 * 64
    assert (s.document(1) == x[10:20_010]).all() and len(s.document(2)) == 0
    for a, z in ((0, 1), (4095, 4097), (29_999, 30_000), (8192, 8192), (17, 29_001)):
        assert (s.ids(a, z) == x[a:z]).all()
    empty = tokens.Shard(tokens.shard_bytes([], [], np.empty(0, np.uint32), 16))
    assert empty.n_ids == 0 and empty.doc_ids == []
    with pytest.raises(ValueError):
        tokens.Shard(b"x" * 200)


def test_words_apart_give_the_ids_of_whole_texts(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_WORDS", 50)
    enc = tokens.Encoder(WORD_BPE)
    rnd = random.Random(1)
    parts = [*"abzABKJ 's't' d .,;:!?()\n\t́̌KÉéß中文😀1２\x00\x1c\x85\xa0 İıŉ'lly", "<|endoftext|>", "don't", "JOHN'S",
             "J̌", "word.", "word,'s", "x.́", "́a", "ends?!", " The ", "<|start", "ẞ", "ﬁ."]
    for _ in range(1500):
        t = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 30)))
        ids, n = enc.flat(pa.array([t, "", t + " " + t]))
        want = [enc.tok.encode(x, add_special_tokens=False).ids for x in (t, "", t + " " + t)]
        assert ids.tolist() == sum(want, []) and n.tolist() == [len(w) for w in want]


@pytest.mark.parametrize("name,by_word,end", [(WORD_BPE, True, 2), (BYTE_BPE, False, None)])
def test_token_files(spark, monkeypatch, name, by_word, end):
    rnd = random.Random(7)
    rows = [(rnd.choice([i, i, -i]), t, None, None, None, "id", "q", i) for i, t in enumerate(texts()) if t is None or len(t) < 2000]
    rows += [rows[4], (None, "no id", *[None] * 6), (rows[6][0], "the same id", *[None] * 6), (99, "Long text. " * 3000, *[None] * 6)]
    monkeypatch.setattr(tokens, "PIECE_CHARS", 5000)
    df, path = spark.createDataFrame(rows, SCHEMA).repartition(4), shared_path(spark, "tok")
    files = materialise(tokens.write(df, path, name, end, by_word=by_word, parts=5, file_ids=700), "tok-files")
    again = tokens.write(df, path, name, end, by_word=by_word, parts=5, file_ids=700).collect()  # a repeated attempt
    assert key(map(tuple, again)) == key(map(tuple, files.collect())) and len(again) > 5
    got = (tokens.read(spark, path).join(tokens.offsets(files), "file")
           .select((F.col("base") + F.col("first")).alias("start"), "id", "n", "ids").orderBy("start", "n", "id").collect())
    tok = Tokenizer.from_file(name)
    plain = [(r[0], tok.encode(r[1] or "", add_special_tokens=False).ids + ([] if end is None else [end])) for r in rows]
    assert [r["id"] for r in got] == sorted([r[0] for r in rows], key=lambda d: (d is not None, d))
    at = 0
    for r in got:
        assert r["n"] * 4 == len(r["ids"])
        assert r["start"] == at
        at += r["n"]
    assert key((r["id"], np.frombuffer(r["ids"], "<u4").tolist()) for r in got) == key(plain)
    direct = tokens.encode(df, name, end, by_word=by_word).collect()
    assert key((r["id"], np.frombuffer(r["ids"], "<u4").tolist()) for r in direct) == key(plain)


def test_token_files_of_an_empty_table(spark):
    df, path = spark.createDataFrame([], SCHEMA), shared_path(spark, "tok")
    files = materialise(tokens.write(df, path, WORD_BPE, 2), "tok-files")
    assert files.count() == 0 and tokens.offsets(files).count() == 0


def test_offsets_over_many_partitions(spark):
    rnd = random.Random(2)
    rows = [(p, s, f"f{p}-{s}", 1, rnd.randint(0, 9)) for p in range(0, 5000, 37) for s in range(2)]
    got = dict(map(tuple, tokens.offsets(spark.createDataFrame(rows, "part long, seq long, file string, n_docs long, n_ids long")).collect()))
    at = 0
    for r in rows:
        assert got[r[2]] == at
        at += r[4]


def test_query_against_whole_texts(spark):
    from ideaweave.llm.queries import QUERIES

    from ..conftest import SF001
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in QUERIES["op11_token_output"](spark, SF001).collect()}
    tok, at = Tokenizer.from_file(WORD_BPE), 0
    for r in spark.read.parquet(f"{SF001}/documents.parquet").orderBy("doc_id").collect():
        ids = np.array(tok.encode(r["text"] or "", add_special_tokens=False).ids + [2], "<u4")
        assert got.pop(r["doc_id"]) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert not got


# -- hard negatives ----------------------------------------------------------------------------

def plain_negatives(rows, anchors, scale=256):
    ok: dict = {}
    for i, label, v in rows:
        if None in (i, label, v) or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = (label, [math.floor(scale * x) for x in v])
        ok[i] = min(ok.get(i, q), q)
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for a in anchors:
        if a not in ok:
            continue
        scored = sorted((-dot(ok[a][1], v), i, label) for i, (label, v) in ok.items() if i != a)
        for s, p, label in [x for x in scored if x[2] == ok[a][0]][:5]:
            near = [x for x in scored if x[2] != ok[a][0] and 50 * -s <= 100 * -x[0] <= 95 * -s][:3]
            out += [(a, p, k + 1, x[1], -s, -x[0]) for k, x in enumerate(near)]
    return out


def vectors(n=260, dim=6, labels=3, seed=1):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(8, dim))
    x = centre[rng.integers(0, 8, n)] + rng.normal(size=(n, dim)) * .4
    x /= np.linalg.norm(x, axis=1)[:, None]
    rows = [(i, int(rng.integers(0, labels)), [float(f) for f in x[i].astype(np.float32)]) for i in range(n)]
    rows[20:60] = [(i, rows[20][1] if i % 2 else (rows[20][1] + 1) % labels, rows[20][2]) for i in range(20, 60)]  # a group of equal vectors
    return rows


def mined(spark, rows, every=10, **index):
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, label long, embedding array<double>, score string").repartition(3)
    r = materialise(negatives.integer_rows(df, "vec_id", F.col("label"), "embedding"), "v")
    return key(map(tuple, negatives.mine(r, negatives.build(r, **index), r.where(F.col("id") % every == 0)).collect()))


@pytest.mark.parametrize("index", [{}, {"cell_rows": 4, "sample": 40}, {"cell_rows": 2, "codewords": 3, "sample": 7}])
def test_hard_negatives(spark, index):
    rows = vectors()
    assert mined(spark, rows, **index) == key(plain_negatives(rows, range(0, 260, 10)))


def test_hard_negatives_of_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(negatives, "CHUNK", 16)  # a hot cell is cut into slices
    monkeypatch.setattr(negatives, "BLOCK", 4)
    rows = vectors(90, 5)
    odd = [(None, 1, rows[0][2]), (300, None, rows[0][2]), (310, 1, None), (320, 1, [0.1, None, 0.2]), (330, 1, [float("nan")] * 5),
           (340, 1, [float("inf")] * 5), (350, 1, [0.5, 0.5]), (360, 2, []), rows[10], (10, rows[10][1] + 1, rows[11][2]),
           (370, 1, [1000.0] * 5), (380, 2, [-1e9, 0.0, 0.0, 0.0, 1.0])]
    got = mined(spark, rows + odd, cell_rows=8)
    assert got == key(plain_negatives(rows + odd, range(0, 400, 10))) and len({r[0] for r in got}) > 5


def test_hard_negatives_of_few_rows(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(0, 1, [1.0, 0.0])]) == []
    rows = [(0, 1, [1.0, 0.0]), (1, 1, [0.9, 0.1]), (2, 2, [0.8, 0.2]), (3, 2, [0.0, 1.0])]
    assert mined(spark, rows) == key(plain_negatives(rows, [0])) != []


def test_visits_are_certified_and_skip_cells(spark):
    rows = vectors(400, 4)
    df = spark.createDataFrame(rows, "vec_id long, label long, embedding array<double>")
    r = materialise(negatives.integer_rows(df, "vec_id", F.col("label"), "embedding"), "v")
    index = negatives.build(r, cell_rows=4)
    batch = pa.Table.from_pandas(index.cells.toPandas(), preserve_index=False).combine_chunks().to_batches()[0]
    cells, total = negatives.Cells(batch, index), sum(len(x[0]) for x in negatives.Cells(batch, index).rows)
    v = {x["id"]: np.array(x["v"]) for x in r.collect()}
    read = 0
    for q in range(0, 400, 20):
        scores = {i: int(v[q] @ x) for i, x in v.items()}
        beat = sorted(scores.values())[-10]
        seen = {}
        for ids, _, s in cells.visit(v[q], lambda: beat):
            seen |= dict(zip(ids.tolist(), s.tolist()))
        assert all(seen[i] == s for i, s in scores.items() if s >= beat) and all(scores[i] == s for i, s in seen.items())
        read += len(seen)
    assert total == 400 and read < 0.7 * 400 * 20


# -- ranked search -----------------------------------------------------------------------------

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(t):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def plain_search(docs, items, k=10):
    found = [(d, Counter(plain_terms(t))) for d, t in docs]
    found = [(d, c) for d, c in found if c]
    n_docs, n_terms = len(found), sum(c.total() for _, c in found)
    df = Counter(t for _, c in found for t in c)
    out = []
    for item, text in items:
        asked = plain_terms(text)
        scored = []
        for d, c in found:
            m = 25 + 75 * c.total() * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m))
                    for t in asked if t in c)
            if s > 0:
                scored.append((-s, d is None, d or 0, d))
        out += [(item, i + 1, x[3], -x[0]) for i, x in enumerate(sorted(scored)[:k])]
    return out


def corpus():
    rnd = random.Random(11)
    words = [f"w{i}" for i in range(40)] + ["The", "the", "of", "é", "ÉCOLE", "école"]
    weight = [1 / (i + 1) for i in range(len(words))]
    docs = [(rnd.randint(0, 400), " ".join(rnd.choices(words, weight, k=rnd.choice([3, 8, 30, 90])))) for _ in range(330)]
    docs += [docs[0], docs[0], (None, docs[1][1]), (None, None), (5, ""), (6, ".. --"), (7, "w3 " * 500)]
    items = [(i, " ".join(rnd.choices(words, k=rnd.choice([1, 4, 12])))) for i in range(12)]
    items += [(None, "w1 w2"), (3, None), (4, ""), (5, "unknown terms"), (6, items[0][1]), (6, items[0][1])]
    return docs, items


def searched(spark, docs, items, k=10):
    d = spark.createDataFrame([(*x, "c") for x in docs], "doc_id long, text string, rank string").repartition(3)
    i = spark.createDataFrame([(*x, "c") for x in items], "item_id long, text string, score string")
    return [tuple(r) for r in lexical.search(materialise(lexical.index(d), "seg"), i, k).collect()]


@pytest.mark.parametrize("docs_in_segment,window,run,short,item_bytes", [(8192, 1024, 128, 64, 1 << 22), (50, 8, 4, 6, 200), (70, 16, 2, 10 ** 9, 1)])
def test_ranked_search(spark, monkeypatch, docs_in_segment, window, run, short, item_bytes):
    for name, value in (("SEGMENT_DOCS", docs_in_segment), ("WINDOW", window), ("RUN", run), ("SHORT", short)):
        monkeypatch.setattr(lexical, name, value)
    monkeypatch.setattr(lexical.item_blocks, "__defaults__", (item_bytes,))
    docs, items = corpus()
    got = searched(spark, docs, items)
    assert key(got) == key(plain_search(docs, items))


def test_stored_segments_come_in_files_of_few_rows(spark, monkeypatch):
    monkeypatch.setattr(lexical, "SEGMENT_DOCS", 20)
    docs, items = corpus()
    d = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    got = lexical.stored(d)
    per_file = [r["n"] for r in got.groupBy(F.input_file_name().alias("f")).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sum(per_file) > 10 and max(per_file) <= lexical.FILE_SEGMENTS
    i = spark.createDataFrame(items, "item_id long, text string")
    assert key([tuple(r) for r in lexical.search(got, i).collect()]) == key(plain_search(docs, items))


def test_search_skips_what_cannot_win(monkeypatch):
    rnd = random.Random(3)
    docs = [(i, Counter({b"common": 1, b"often": 1 + i % 2, (b"rare" if i % 400 == 7 else b"x%d" % i): 3})) for i in range(4000)]
    vocabulary = {t: n for n, t in enumerate(sorted({t for _, c in docs for t in c}))}
    rnd.shuffle(docs)
    found = [(np.array([vocabulary[t] for t in c], np.int32), np.array(list(c.values()), np.int32)) for _, c in docs]
    row = dict(zip([x.split()[0] for x in lexical.SEGMENT.split(", ")],
                   lexical.segment([d for d, _ in docs], [c.total() for _, c in docs], found, vocabulary)))
    query = [(b"common", 5), (b"often", 7), (b"rare", 9000)]
    seg = lexical.Segment(row, {t for t, _ in query}, 4000, sum(c.total() for _, c in docs))
    read = []
    whole = lexical.Segment.postings
    monkeypatch.setattr(lexical.Segment, "postings", lambda self, a, z: read.append(z - a) or whole(self, a, z))
    docs_at, _ = seg.search(query, 5)
    assert {seg.ids[d] % 400 for d in docs_at.tolist()} == {7}
    assert sum(read) < 0.2 * 8010  # the long lists answer probes only


def test_search_of_empty_tables(spark):
    docs, items = corpus()
    assert searched(spark, [], items) == [] and searched(spark, docs, []) == []
    assert searched(spark, docs, [(1, None)]) == []


def test_terms_of_a_long_text(monkeypatch):
    t = " ".join(f"Word{i % 13}é" for i in range(3000))
    whole = lexical.term_counts(t)
    monkeypatch.setattr(lexical, "PIECE", 97)
    assert lexical.term_counts(t) == whole and whole.total() == 3000


def test_runs_of_ids_are_gathered_with_bounded_positions():
    import tracemalloc

    rng = np.random.default_rng(5)
    n = rng.integers(0, 40, 1000)
    pool, pick = rng.integers(0, 49_000, n.sum()).astype(np.uint32), rng.integers(0, 1000, 100_000)
    tracemalloc.start()
    got = tokens._gather(pool, n, pick)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    runs = np.split(pool, np.cumsum(n)[:-1])
    assert got.dtype == np.uint32 and np.array_equal(got, np.concatenate([runs[i] for i in pick]))
    assert peak < 24 << 20  # two million ids: positions of all at once take 16 MB an array
    assert len(tokens._gather(pool, n, np.empty(0, np.int64))) == 0
