"""Ranked lexical search: a segmented inverted index and a hybrid of term- and document-at-a-time.

``index`` cuts the documents into segments of bounded size where they are; a segment is one row with
its documents in id order, its terms, their postings (document, count) and, per ``RUN`` postings, the
largest count and the shortest document, from which a bound follows without reading them.

``search`` takes the items in blocks of bounded size. Per segment and item the short lists are
summed term at a time into accumulators, which are then one more iterator with a bound among the long
lists. Those are walked document at a time, a window of documents after the other: a window whose
bounds do not reach the score to beat is skipped unread; inside a window the iterators of smallest
bounds, whose sum cannot reach that score alone, only answer probes for documents that others bring.
The scores to beat go from segment to segment of a task; the best of all tasks are merged.

Defined results: a null text has no terms; documents and items without terms give no rows and are not
counted; equal rows are documents (or items) of their own; null document ids come last among equal
scores; empty tables give an empty result; other columns are not read.
"""

from __future__ import annotations

import itertools
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SEGMENT_TERMS = 1 << 20
SEGMENT_DOCS = 8192
FILE_SEGMENTS = 2  # segments of a stored file, all of which a task reads or writes at once
RUN = 128  # postings under one bound
WINDOW = 1024  # documents walked at a time
SHORT = 64  # lists of at most one 64th of the segment's documents are short
PIECE = 4 << 20
ITEM_BYTES = 4 << 20  # text of the items of one block


def term_counts(text: str) -> Counter:
    """Terms of a text; long texts are taken in pieces cut between terms."""
    data = text.encode("utf-8", "replace").lower()  # bytes: A-Z only
    if len(data) <= PIECE:
        return Counter(TERM.findall(data))
    counts: Counter = Counter()
    a = 0
    while a < len(data):
        z = min(a + PIECE, len(data))
        m = TERM.match(data, z) if z < len(data) else None
        z = m.end() if m else z
        counts.update(TERM.findall(data[a:z]))
        a = z
    return counts


# -- index -------------------------------------------------------------------------------------

SEGMENT = ("n_docs long, n_terms long, doc_ids array<long>, lengths binary, terms binary, starts binary, "
           "docs binary, counts binary, run_starts binary, run_count binary, run_length binary")
RAW = frozenset(("lengths", "starts", "docs", "counts", "run_starts", "run_count", "run_length"))  # read where they lie


def segment(doc_ids: list, lengths: list, found: list, vocabulary: dict):
    """Columns of one segment row. ``found``: per document its term codes and their counts."""
    order = sorted(range(len(doc_ids)), key=lambda i: (doc_ids[i] is None, doc_ids[i] or 0, lengths[i]))
    ids, n = [doc_ids[i] for i in order], np.array([lengths[i] for i in order], np.int64)
    docs = np.repeat(np.arange(len(order), dtype=np.int32), [len(found[i][0]) for i in order])
    codes = np.concatenate([found[i][0] for i in order])
    counts = np.concatenate([found[i][1] for i in order])
    by_term = np.argsort(codes, kind="stable")
    docs, counts = docs[by_term], counts[by_term]
    size = np.bincount(codes, minlength=len(vocabulary))
    starts = np.concatenate([[0], np.cumsum(size)])
    runs = -(-size // RUN)
    run_starts = np.concatenate([[0], np.cumsum(runs)])
    first = np.repeat(starts[:-1] - run_starts[:-1] * RUN, runs) + np.arange(run_starts[-1]) * RUN
    raw = lambda x, t="<i4": np.ascontiguousarray(x, t).tobytes()
    return (len(ids), int(n.sum()), ids, raw(n, "<i8"), b"\n".join(vocabulary), raw(starts), raw(docs), raw(counts),
            raw(run_starts), raw(np.maximum.reduceat(counts, first)), raw(np.minimum.reduceat(n[docs], first), "<i8"))


def index(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per segment (``SEGMENT``). Lazy; no shuffle."""
    rows = df.select(df[id_col].cast("long").alias("id"), df[text].alias("text")).where("text is not null")
    types = [pa.int64(), pa.int64(), pa.list_(pa.int64()), *[pa.binary()] * 8]
    names = [c.split()[0] for c in SEGMENT.split(", ")]

    def run(batches):
        def fresh():
            return [], [], [], defaultdict(itertools.count().__next__)

        doc_ids, lengths, found, vocabulary = fresh()
        held = 0
        for b in batches:
            for d, t in zip(b.column(0).to_pylist(), b.column(1)):
                counts = term_counts(t.as_py())
                if not counts:
                    continue
                doc_ids.append(d)
                lengths.append(counts.total())
                found.append((np.fromiter(map(vocabulary.__getitem__, counts), np.int32, len(counts)),
                              np.fromiter(counts.values(), np.int32, len(counts))))
                held += lengths[-1]
                if held >= SEGMENT_TERMS or len(doc_ids) >= SEGMENT_DOCS:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([c], k) for c, k in zip(segment(doc_ids, lengths, found, vocabulary), types)], names=names)
                    (doc_ids, lengths, found, vocabulary), held = fresh(), 0
        if doc_ids:
            yield pa.RecordBatch.from_arrays(
                [pa.array([c], k) for c, k in zip(segment(doc_ids, lengths, found, vocabulary), types)], names=names)

    return rows.mapInArrow(run, SEGMENT)


def stored(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``index``, written to the shared folder in files of few segments."""
    return materialise(index(df, id_col, text), "segments", FILE_SEGMENTS)


# -- search ------------------------------------------------------------------------------------


def impact(count, length, n_docs: int, n_terms: int):
    """What a term of weight 1 adds to a document's score."""
    m = 25 + (75 * length * n_docs) // n_terms
    return (1_000_000_000 * count) // (1000 * count + 8 * m)


def weight(df: int, n_docs: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Segment:
    """One stored segment, with the lists of the wanted terms."""

    def __init__(self, row: dict, wanted, n_docs: int, n_terms: int):
        self.ids = row["doc_ids"]
        self.n = int(row["n_docs"])
        self.lengths = np.frombuffer(row["lengths"], "<i8")
        self.starts = np.frombuffer(row["starts"], "<i4")
        self.docs = np.frombuffer(row["docs"], "<i4")
        self.counts = np.frombuffer(row["counts"], "<i4")
        self.run_starts = np.frombuffer(row["run_starts"], "<i4")
        self.run_count = np.frombuffer(row["run_count"], "<i4")
        self.run_length = np.frombuffer(row["run_length"], "<i8")
        self.at = {t: i for i, t in enumerate(row["terms"].split(b"\n")) if t in wanted}
        self.total = (n_docs, n_terms)
        self.edges = np.arange(0, self.n + WINDOW, WINDOW)
        self._windows: dict = {}

    def postings(self, a: int, z: int):
        """Documents and impacts of the postings ``a`` to ``z``."""
        docs = self.docs[a:z]
        return docs, impact(self.counts[a:z].astype(np.int64), self.lengths[docs], *self.total)

    def windows(self, term: int):
        """Per window of documents: first posting, bound of the impacts (0: no posting)."""
        if term not in self._windows:
            a, z = self.starts[term], self.starts[term + 1]
            cut = np.searchsorted(self.docs[a:z], self.edges)
            r0, r1 = self.run_starts[term], self.run_starts[term + 1]
            bound = impact(self.run_count[r0:r1].astype(np.int64), self.run_length[r0:r1], *self.total)
            lo, hi = cut[:-1] // RUN, np.maximum(cut[1:] - 1, 0) // RUN
            lo = np.minimum(lo, len(bound) - 1)
            most = np.array([bound[x:max(x, y) + 1].max() for x, y in zip(lo.tolist(), hi.tolist())])
            self._windows[term] = (cut + a, np.where(cut[1:] > cut[:-1], most, 0))
        return self._windows[term]

    def search(self, query: list[tuple[bytes, int]], k: int, beat: int = 0):
        """``(documents, scores)`` of the ``k`` best above 0, of those that reach ``beat``."""
        lists = [(w, self.at[t]) for t, w in query if w > 0 and t in self.at]
        long, acc = [], np.zeros(self.n, np.int64)
        for w, t in lists:  # term at a time
            a, z = self.starts[t], self.starts[t + 1]
            if (z - a) * SHORT > self.n:
                long.append((w, t))
                continue
            docs, x = self.postings(a, z)
            acc[docs] += w * x
        beat = max(beat, 1)
        if self.n > k:
            beat = max(beat, int(np.partition(acc, self.n - k)[self.n - k]))  # sums so far are lower bounds
        best_d, best_s = np.empty(0, np.int64), np.empty(0, np.int64)
        n_win = len(self.edges) - 1
        bounds = np.zeros((len(long) + 1, n_win), np.int64)  # the last iterator: the accumulators
        cuts = []
        for i, (w, t) in enumerate(long):
            cut, most = self.windows(t)
            cuts.append(cut)
            bounds[i] = w * most
        bounds[-1] = np.maximum.reduceat(acc, self.edges[:-1])
        whole = bounds.sum(axis=0)
        for v in range(n_win):  # document at a time
            if whole[v] < beat:
                continue
            base = int(self.edges[v])
            score = acc[base:base + WINDOW].copy()
            order = np.argsort(bounds[:, v], kind="stable")
            below = np.cumsum(bounds[order, v])
            probe = int(np.searchsorted(below, beat))  # iterators that cannot reach the score alone
            brought = np.zeros(len(score), bool)
            for i in order[probe:].tolist():
                if i == len(long):
                    brought |= score > 0
                    continue
                docs, x = self.postings(cuts[i][v], cuts[i][v + 1])
                score[docs - base] += long[i][0] * x
                brought[docs - base] = True
            alive = np.flatnonzero(brought)
            for j in range(probe - 1, -1, -1):
                i = int(order[j])
                alive = alive[score[alive] + below[j] >= beat] if i != len(long) else alive
                if not len(alive):
                    break
                if i == len(long) or not bounds[i, v]:
                    continue
                a, z = cuts[i][v], cuts[i][v + 1]
                docs = self.docs[a:z]
                at = np.minimum(np.searchsorted(docs, alive + base), len(docs) - 1)
                same = docs[at] == alive + base
                hit, at = alive[same], at[same] + a
                score[hit] += long[i][0] * impact(self.counts[at].astype(np.int64), self.lengths[hit + base], *self.total)
            alive = alive[score[alive] >= beat]
            if len(alive):
                best_d, best_s = np.concatenate([best_d, alive + base]), np.concatenate([best_s, score[alive]])
                if len(best_d) > k:
                    keep = np.lexsort((best_d, -best_s))[:k]
                    best_d, best_s = best_d[keep], best_s[keep]
                if len(best_d) == k:
                    beat = max(beat, int(best_s.min()))
        return best_d, best_s


def item_blocks(items: DataFrame, id_col: str, text: str, limit: int = ITEM_BYTES) -> Iterator[list]:
    """Lists of ``(id, text)`` with about ``limit`` bytes of text each (one item more at most)."""
    stored = materialise(items.select(items[id_col].alias("id"), items[text].alias("text")).where("text is not null")
                         .withColumns({"lot": F.spark_partition_id(), "at": F.monotonically_increasing_id()}), "items")
    total = Window.partitionBy("lot").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    cut = F.floor(F.coalesce(F.sum(F.octet_length("text") + 64).over(total), F.lit(0)) / limit)
    blocks = materialise(stored.withColumn("block", cut), "item-blocks")
    for key in [(r["lot"], r["block"]) for r in blocks.select("lot", "block").distinct().sort("lot", "block").toLocalIterator()]:
        yield [(r["id"], r["text"]) for r in blocks.where((F.col("lot") == key[0]) & (F.col("block") == key[1])).sort("at").collect()]


def search(segments: DataFrame, items: DataFrame, k: int = 10, id_col: str = "item_id", text: str = "text") -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` best documents of each item.

    ``segments``: rows of ``index``, stored (``stored``).
    """
    spark = segments.sparkSession
    n_docs, n_terms = segments.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    kind = items.schema[id_col].dataType
    out = None
    for block in item_blocks(items, id_col, text):
        got = _search_block(segments, block, int(n_docs), int(n_terms), k)
        ids = spark.createDataFrame([(q, i) for q, (i, _) in enumerate(block)], f"q int, item_id {kind.simpleString()}")
        best = Window.partitionBy("q").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        top = (got.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
               .join(F.broadcast(ids), "q").select("item_id", "rank", "doc_id", "score"))
        out = top if out is None else out.union(top)
    if out is None:
        return spark.createDataFrame([], f"item_id {kind.simpleString()}, rank int, doc_id long, score long")
    return out


def _search_block(segments: DataFrame, block: list, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """``(q, doc_id, score)``: per task the ``k`` best documents of each item of the block."""
    asked = [term_counts(t) for _, t in block]
    wanted = frozenset(t for c in asked for t in c)

    def count(batches):
        total: Counter = Counter()
        for b in batches:
            for terms, starts in zip(b.column(0), b.column(1)):
                size = np.diff(np.frombuffer(starts.as_buffer(), "<i4")).tolist()
                total.update({t: n for t, n in zip(terms.as_py().split(b"\n"), size) if t in wanted})
        if total:
            yield pa.RecordBatch.from_pydict({"term": pa.array(list(total), pa.binary()), "df": pa.array(list(total.values()), pa.int64())})

    dfs = segments.select("terms", "starts").mapInArrow(count, "term binary, df long").groupBy("term").agg(F.sum("df").alias("df"))
    weights = {bytes(r["term"]): weight(r["df"], n_docs) for r in dfs.toLocalIterator()}  # terms of this block
    queries = [[(t, weights[t] * n) for t, n in c.items() if t in weights] for c in asked]

    def run(batches):
        best: list = [([], []) for _ in queries]  # document ids and scores per item
        for b in batches:
            for i in range(b.num_rows):
                seg = Segment({n: c[i].as_buffer() if n in RAW else c[i].as_py() for n, c in zip(b.schema.names, b.columns)},
                              weights, n_docs, n_terms)
                for q, query in enumerate(queries):
                    ids, scores = best[q]
                    docs, s = seg.search(query, k, min(scores) if len(scores) == k else 0)
                    if len(docs):
                        both = [*zip(scores, ids), *zip(s.tolist(), (seg.ids[d] for d in docs.tolist()))]
                        both = sorted(both, key=lambda x: (-x[0], x[1] is None, x[1] or 0))[:k]
                        best[q] = ([d for _, d in both], [x for x, _ in both])
        n = [len(d) for d, _ in best]
        if sum(n):
            yield pa.RecordBatch.from_pydict({
                "q": pa.array(np.repeat(np.arange(len(n)), n), pa.int32()),
                "doc_id": pa.array([x for d, _ in best for x in d], pa.int64()),
                "score": pa.array([x for _, s in best for x in s], pa.int64())})

    return segments.mapInArrow(run, "q int, doc_id long, score long")
