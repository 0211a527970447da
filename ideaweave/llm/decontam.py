"""Benchmark decontamination by a prefix-filtered set join.

A shingle is ten consecutive words of a benchmark item (a shorter item is one shingle). It occurs
in a document only if all its words do, so its rarest word (by frequency over all documents) is a
necessary prefix: only positions of such words are looked at. The place of the word inside the
shingle fixes where the shingle would begin (positional bound) and end (length bound); the words
there are then compared. Found shingles are set against item-sized windows of the document for the
share of the item's shingles that one window contains.

The benchmark goes to the tasks in blocks of at most ``block_bytes`` of text; a larger benchmark
makes more passes over the documents, never a larger block. Documents are not shuffled.

Defined results: a null text or item has no words, hits or windows; repeated items and rows count
by their own id and row; items that share an id count once; a null item_id has no place in the
sorted ids and is left out of them, though its words are hit; other columns pass through.
"""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SHINGLE = 10
BLOCK_BYTES = 8 << 20
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text: str | None) -> list[bytes]:
    """Words of a text: A-Z in lower case, runs of letters, digits and non-ASCII characters."""
    return _WORD.findall(text.encode("utf-8", "replace").lower()) if text else []


def word_counts(df: DataFrame, text: str, vocabulary: frozenset) -> dict:
    """How often each word of ``vocabulary`` occurs in all documents (as many counts as words at most)."""
    def count(batches):
        total: Counter = Counter()
        for b in batches:
            for v in b.column(0):
                c = Counter(words_of(v.as_py()))
                for w in c.keys() & vocabulary:
                    total[w] += c[w]
        yield pa.RecordBatch.from_pydict({"w": pa.array(list(total), pa.binary()),
                                          "n": pa.array(list(total.values()), pa.int64())})

    got = df.select(text).mapInArrow(count, "w binary, n long").groupBy("w").agg(F.sum("n").alias("n"))
    return {bytes(r["w"]): r["n"] for r in got.collect()}


class Index:
    """Shingles of a block of items, by their rarest word."""

    def __init__(self, items, counts: dict, size: int = SHINGLE):
        shingles: dict[tuple, dict] = {}
        self.length: list[int] = []
        self.ids: list[str | None] = []
        self.total: list[int] = []
        for k, (item_id, words) in enumerate(items):
            self.ids.append(None if item_id is None else str(item_id))
            self.length.append(len(words))
            own = {tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()
            self.total.append(len(own))
            for s in own:
                shingles.setdefault(s, {})[k] = True
        self.by_prefix: dict[bytes, list] = {}
        for number, (s, who) in enumerate(sorted(shingles.items())):
            rare = min(range(len(s)), key=lambda i: (counts.get(s[i], 0), s[i], i))
            self.by_prefix.setdefault(s[rare], []).append((rare, list(s), tuple(who), number))

    def find(self, words: list[bytes]):
        """Occurrences (start, end, items, shingle number) in a document's words."""
        prefix, out, n = self.by_prefix, [], len(words)
        for p in [i for i, w in enumerate(words) if w in prefix]:
            for rare, s, who, number in prefix[words[p]]:
                a = p - rare
                if a >= 0 and a + len(s) <= n and words[a:a + len(s)] == s:
                    out.append((a, a + len(s), who, number))
        return out

    def containment(self, found) -> float:
        """Largest share of an item's shingles inside one window of the item's length."""
        by_item: dict[int, list] = {}
        for a, b, who, number in found:
            for k in who:
                by_item.setdefault(k, []).append((a, b, number))
        best = 0.0
        for k, hits in by_item.items():
            hits.sort()
            lo, inside = 0, Counter()
            for a, b, number in hits:
                inside[number] += 1
                while hits[lo][0] < b - self.length[k]:
                    inside[hits[lo][2]] -= 1
                    if not inside[hits[lo][2]]:
                        del inside[hits[lo][2]]
                    lo += 1
                best = max(best, len(inside) / self.total[k])
        return best


def blocks_of(benchmark: DataFrame, item_id: str, text: str, block_bytes: int):
    """The items in hash-dealt blocks of bounded text, one block at a time."""
    rows = benchmark.select(benchmark[item_id].cast("string").alias("id"), benchmark[text].alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    for b in range(n):
        part = rows if n == 1 else rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == b)
        yield sorted(((r["id"], words_of(r["text"])) for r in part.collect()), key=lambda x: (x[0] or "", x[1]))


def decontaminate(df: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", out: str = "leak", size: int = SHINGLE,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``df`` with a struct column ``out``: ``n_words``, ``spans`` (hit word ranges, merged), ``items``
    (sorted distinct ids with a shingle that occurs) and ``containment``."""
    pair = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    kind = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("spans", T.ArrayType(pair)),
                         T.StructField("items", T.ArrayType(T.StringType())),
                         T.StructField("containment", T.DoubleType())])
    pair_pa = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    names, at = df.columns, df.columns.index(text)
    result = df
    for items in blocks_of(benchmark, item_id, item_text, block_bytes):
        vocabulary = frozenset(w for _, ws in items for w in ws)
        index = df.sparkSession.sparkContext.broadcast(Index(items, word_counts(df, text, vocabulary), size))
        later = out in result.columns

        def run(batches, index=index, later=later):
            ix = index.value
            for batch in batches:
                n_words, spans, ids, share = [], [], [], []
                old = batch.column(len(names)).to_pylist() if later else [None] * batch.num_rows
                for v, was in zip(batch.column(at), old):
                    words = words_of(v.as_py())
                    found = ix.find(words)
                    got = {ix.ids[k] for f in found for k in f[2]} - {None}
                    ranges = [(f[0], f[1]) for f in found]
                    best = ix.containment(found) if found else 0.0
                    if was:
                        got |= set(was["items"])
                        ranges += [(s["start"], s["end"]) for s in was["spans"]]
                        best = max(best, was["containment"])
                    n_words.append(len(words))
                    spans.append([{"start": a, "end": b} for a, b in merged(ranges)])
                    ids.append(sorted(got))
                    share.append(best)
                res = pa.StructArray.from_arrays(
                    [pa.array(n_words, pa.int64()), pa.array(spans, pa.list_(pair_pa)),
                     pa.array(ids, pa.list_(pa.string())), pa.array(share, pa.float64())],
                    names=["n_words", "spans", "items", "containment"])
                yield pa.RecordBatch.from_arrays([*batch.columns[:len(names)], res], names=[*names, out])

        result = result.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(out, kind)]))
    return result


def merged(ranges):
    """Maximal runs of overlapping or touching ranges."""
    out: list[list[int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out
