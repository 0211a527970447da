"""Hard negatives by an inverted multi-index.

The components of a vector are cut in two halves; each half has its own codebook, and the pair of
nearest codewords is the vector's cell. For an anchor, a codeword bounds the half score of all its
vectors from above (score of the codeword plus the anchor's half length times the codeword's radius);
a heap visits the pairs of codewords in descending order of the two summed bounds, and stops where
the next sum is below the score that every window still open has to beat. So the answer is exact:
the codebooks, fitted on a bounded sample, only decide how much is read.

The vectors are stored as packed rows by cell, at most ``CHUNK`` in a row, so a cell of any size is
spread. The anchors come in blocks of bounded size against all of them, in two passes: the anchor's
first positives, then for each positive's window the first negatives. Scores found in the sample give
a first score to beat. Components are integers; scores are exact (floating point only where all sums
are below its limit, else 64-bit integers).

Defined results: rows with a null id, label or vector, or with a null or non-finite component take no
part; an id is one row (of rows that repeat it, the one of smallest label, then vector); a vector
shorter than the longest has zeros at its end; equal scores go by smaller id; an anchor without
positives, or a positive without negatives in its window, gives no rows; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

SCALE = 256
SAMPLE = 4096  # rows the codebooks are fitted on, and that give first scores to beat
CODEWORDS = 64  # of a half, at most
CELL_ROWS = 256  # vectors of a cell on average, while the codebooks are smaller than that
CHUNK = 1024
BLOCK = 16384  # anchors of a block
PART_BYTES = 32 << 20
POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95  # a negative's score in percent of its positive's


def integer_rows(df: DataFrame, id_col: str, label: Column, vector: str, scale: int = SCALE) -> DataFrame:
    """``(id, label, v)``, one row per id; components are ``floor(scale * x)``."""
    x = F.transform(df[vector], lambda c: c.cast("double"))
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    rows = df.select(df[id_col].cast("long").alias("id"), label.cast("long").alias("label"), x.alias("x"), bad.alias("bad"))
    rows = rows.where("id is not null and label is not null and x is not null and not bad")
    v = F.transform("x", lambda c: F.floor(c * F.lit(float(scale))).cast("long"))
    return (rows.select("id", "label", v.alias("v")).groupBy("id").agg(F.min(F.struct("label", "v")).alias("r"))
            .select("id", "r.label", "r.v"))


# -- codebooks ---------------------------------------------------------------------------------


def codebook(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """At most ``k`` centroids of the rows of ``x`` (farthest-first start, then means)."""
    centre = [x.mean(axis=0)] if len(x) else [np.zeros(x.shape[1])]
    far = ((x - centre[0]) ** 2).sum(axis=1)
    while len(centre) < k and len(x) and far.max() > 0:
        centre.append(x[far.argmax()])
        far = np.minimum(far, ((x - centre[-1]) ** 2).sum(axis=1))
    c = np.array(centre, float)
    for _ in range(rounds if len(x) else 0):
        near = nearest(x, c)
        n = np.bincount(near, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        c = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], c)
    return c


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return ((c ** 2).sum(axis=1)[None, :] - 2 * (x @ c.T)).argmin(axis=1)


@dataclass
class Index:
    """Codebooks of both halves, the stored cells, and the sample."""

    dim: int
    kind: type  # numbers in which scores are summed exactly
    packed: str  # numbers in which vectors are stored
    books: tuple
    cells: DataFrame
    sample: tuple = field(repr=False)  # ids, labels, vectors


def _matrix(column, n: int, dim: int) -> np.ndarray:
    """Rows of a list column as a matrix, zeros behind short vectors."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    size = np.diff(column.offsets.to_numpy())
    if n and (size == dim).all():
        return flat.reshape(n, dim)
    out = np.zeros((n, dim), np.int64)
    at = np.concatenate([[0], np.cumsum(size)])
    for i, (a, z) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())):
        out[i, :z - a] = flat[a:z]
    return out


def build(rows: DataFrame, sample: int = SAMPLE, codewords: int = CODEWORDS, cell_rows: int = CELL_ROWS) -> Index:
    """The index of stored rows of ``integer_rows``."""
    spark = rows.sparkSession
    n, dim, most = rows.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0)),
                            F.coalesce(F.max(F.array_max(F.transform("v", F.abs))), F.lit(0))).first()
    dim = max(2, dim)
    kind = np.float32 if dim * most * most < 1 << 24 else np.float64 if dim * most * most < 1 << 53 else np.int64
    packed = "<i2" if most < 1 << 15 else "<i8"
    h = F.xxhash64("id")
    share = min(1.0, 4.0 * sample / max(n, 1))  # hashes below a threshold before they are ranked
    few = (rows.where(F.shiftrightunsigned(h, 1) <= F.lit(min((1 << 63) - 1, int(share * (1 << 63))))).withColumn("h", h)
           .orderBy("h", "id").limit(sample).select("id", "label", "v").collect())
    vectors = np.zeros((len(few), dim), np.int64)
    for i, r in enumerate(few):
        vectors[i, :len(r["v"])] = r["v"]
    half, k = dim // 2, int(min(codewords, max(2, round((n / cell_rows) ** 0.5))))
    books = codebook(vectors[:, :half].astype(float), k), codebook(vectors[:, half:].astype(float), k)

    def assign(batches):
        for b in batches:
            v = _matrix(b.column(2), b.num_rows, dim)
            code = [nearest(x.astype(float), c) for x, c in zip((v[:, :half], v[:, half:]), books)]
            data = np.ascontiguousarray(v, packed)
            yield pa.RecordBatch.from_arrays(
                [pa.array(code[0], pa.int32()), pa.array(code[1], pa.int32()), b.column(0), b.column(1),
                 pa.array([x.tobytes() for x in data], pa.binary())], names=["c1", "c2", "id", "label", "v"])

    coded = materialise(rows.select("id", "label", "v").mapInArrow(assign, "c1 int, c2 int, id long, label long, v binary"), "cells-rows")
    parts = max(spark.sparkContext.defaultParallelism, -(-n * dim * np.dtype(packed).itemsize // PART_BYTES))
    # a cell above one CHUNK is dealt out by id; there are at most codewords ** 2 cells
    size = coded.groupBy("c1", "c2").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("slices"))
    dealt = (coded.join(F.broadcast(size.where("slices > 1")), ["c1", "c2"], "left")
             .withColumn("slice", F.pmod(F.xxhash64("id"), F.coalesce("slices", F.lit(1)))))

    def pack(batches):
        """Rows of a cell that follow each other, as one packed row with the radii of its halves."""
        key, held = None, []

        def close():
            ids, labels, data = zip(*held)
            v = np.frombuffer(b"".join(data), packed).reshape(len(ids), dim).astype(float)
            radii = [float(np.sqrt(((x - c[i]) ** 2).sum(axis=1).max())) for x, c, i in
                     zip((v[:, :half], v[:, half:]), books, key)]
            return pa.RecordBatch.from_arrays(
                [pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()), pa.array([radii[0]]), pa.array([radii[1]]),
                 pa.array([np.array(ids, "<i8").tobytes()], pa.binary()), pa.array([np.array(labels, "<i8").tobytes()], pa.binary()),
                 pa.array([b"".join(data)], pa.binary())], names=["c1", "c2", "r1", "r2", "ids", "labels", "v"])

        for b in batches:
            for c1, c2, i, label, v in zip(*[c.to_pylist() for c in b.columns]):
                if held and ((c1, c2) != key or len(held) >= CHUNK):
                    yield close()
                    held = []
                key = (c1, c2)
                held.append((i, label, v))
        if held:
            yield close()

    cells = (dealt.repartition(int(parts), "c1", "c2", "slice").sortWithinPartitions("c1", "c2", "id")
             .select("c1", "c2", "id", "label", "v")
             .mapInArrow(pack, "c1 int, c2 int, r1 double, r2 double, ids binary, labels binary, v binary"))
    ids = np.array([r["id"] for r in few], np.int64)
    return Index(dim, kind, packed, books, materialise(cells, "cells"), (ids, np.array([r["label"] for r in few], np.int64), vectors))


# -- search ------------------------------------------------------------------------------------


class Cells:
    """The cells of one batch of packed rows, with the bounds of their codewords."""

    def __init__(self, batch, index: Index):
        self.half, self.books, self.kind = index.dim // 2, index.books, index.kind
        c1, c2, r1, r2 = (np.array(c.to_pylist()) for c in batch.columns[:4])
        self.rows = []
        at: dict = {}
        for i, (ids, labels, v) in enumerate(zip(*[c.to_pylist() for c in batch.columns[4:]])):
            self.rows.append((np.frombuffer(ids, "<i8"), np.frombuffer(labels, "<i8"),
                              np.frombuffer(v, index.packed).reshape(-1, index.dim).astype(self.kind)))
            at.setdefault((int(c1[i]), int(c2[i])), []).append(i)
        self.at, self.radii = at, (r1, r2)
        self.words = [np.unique(c) for c in (c1, c2)]
        self.reach = [np.array([r[c == w].max() for w in words]) for r, c, words in zip((r1, r2), (c1, c2), self.words)]

    def visit(self, q: np.ndarray, beat):
        """Rows of cells in descending order of their bounds; ``beat()`` is the score still to reach."""
        parts = q[:self.half].astype(float), q[self.half:].astype(float)
        length = [float(np.sqrt((p ** 2).sum())) for p in parts]
        dots = [c[w] @ p for c, w, p in zip(self.books, self.words, parts)]
        bound = [d + n * r for d, n, r in zip(dots, length, self.reach)]
        order = [np.argsort(-b, kind="stable") for b in bound]
        f, g = bound[0][order[0]].tolist(), bound[1][order[1]].tolist()
        words = [w[o].tolist() for w, o in zip(self.words, order)]
        dots = [d[o].tolist() for d, o in zip(dots, order)]
        slack = 1e-9 * (1 + sum(length) * (sum(length) + max(map(abs, f)) + max(map(abs, g))))
        heap, seen = [(-(f[0] + g[0]), 0, 0)], {(0, 0)}
        while heap:
            upper, a, b = heapq.heappop(heap)
            if -upper + slack < beat():
                return  # certified: no cell left can reach the score
            for x, y in ((a + 1, b), (a, b + 1)):
                if x < len(f) and y < len(g) and (x, y) not in seen:
                    seen.add((x, y))
                    heapq.heappush(heap, (-(f[x] + g[y]), x, y))
            for i in self.at.get((words[0][a], words[1][b]), ()):
                if dots[0][a] + dots[1][b] + length[0] * self.radii[0][i] + length[1] * self.radii[1][i] + slack >= beat():
                    ids, labels, v = self.rows[i]
                    yield ids, labels, (v @ q.astype(self.kind)).astype(np.int64)


class Best:
    """The first ``k`` (score descending, id ascending) of what is added, and the score to beat."""

    def __init__(self, k: int, beat: int | None = None):
        self.k, self.beat = k, beat
        self.scores, self.ids = np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        if self.beat is not None:
            keep = scores >= self.beat
            scores, ids = scores[keep], ids[keep]
        if not len(scores):
            return
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        order = np.lexsort((ids, -scores))[:self.k]
        self.scores, self.ids = scores[order], ids[order]
        if len(order) == self.k:
            self.beat = max(int(self.scores[-1]), self.beat if self.beat is not None else int(self.scores[-1]))


def positives_pass(batches, index_of, anchors, first: list[Best]):
    """Adds every cell's rows of the anchor's label to the anchor's ``Best``."""
    ids, labels, vectors = anchors
    for batch in batches:
        if not batch.num_rows:
            continue
        cells = index_of(batch)
        for q in range(len(ids)):
            best = first[q]
            low = float("-inf")
            for cid, clabel, score in cells.visit(vectors[q], lambda: low if best.beat is None else best.beat):
                same = (clabel == labels[q]) & (cid != ids[q])
                best.add(score[same], cid[same])


def in_window(score: np.ndarray, positive: int) -> np.ndarray:
    return (LOW * positive <= 100 * score) & (100 * score <= HIGH * positive)


def negatives_pass(batches, index_of, anchors, positives: list, first: list):
    """Adds the rows of other labels inside a window to the window's ``Best``; a visit ends when all windows are certified."""
    ids, labels, vectors = anchors
    for batch in batches:
        if not batch.num_rows:
            continue
        cells = index_of(batch)
        for q in range(len(ids)):
            windows = [(p, b) for p, b in zip(positives[q], first[q]) if LOW * p <= HIGH * p]
            if not windows:
                continue

            def beat():
                return min(-(-LOW * p // 100) if b.beat is None else b.beat for p, b in windows)

            for cid, clabel, score in cells.visit(vectors[q], beat):
                other = clabel != labels[q]
                s, i = score[other], cid[other]
                for p, b in windows:
                    ok = in_window(s, p)
                    if ok.any():
                        b.add(s[ok], i[ok])


def _seed(k: int, scores: np.ndarray) -> Best:
    """A score to beat from sampled rows (which the pass meets again): that of the ``k``-th."""
    return Best(k, int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else None)


def anchor_blocks(rows: DataFrame, block: int = BLOCK):
    """Rows in lists of about ``block``: dealt round, so a block has ``block`` rows and one for each input partition at most."""
    stored = materialise(rows, "anchors")
    n = stored.count()
    parts = max(1, -(-n // block))
    dealt = materialise(stored.repartition(parts).withColumn("block", F.spark_partition_id()), "anchor-blocks") if parts > 1 \
        else stored.withColumn("block", F.lit(0))
    for k in range(parts):
        got = dealt.where(F.col("block") == k).sort("id").collect()
        if got:
            yield got


def mine(rows: DataFrame, index: Index, anchors: DataFrame, n_positives: int = POSITIVES, n_negatives: int = NEGATIVES) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)`` for all anchors.

    ``anchors``: the rows of ``rows`` to mine for.
    """
    spark, light = rows.sparkSession, Index(index.dim, index.kind, index.packed, index.books, None, None)
    sid, slabel, svec = index.sample[0], index.sample[1], index.sample[2].astype(index.kind)
    done = None
    for block in anchor_blocks(anchors):
        ids, labels = np.array([r["id"] for r in block], np.int64), np.array([r["label"] for r in block], np.int64)
        vectors = np.zeros((len(block), index.dim), np.int64)
        for i, r in enumerate(block):
            vectors[i, :len(r["v"])] = r["v"]
        of = lambda q: (svec @ vectors[q].astype(index.kind)).astype(np.int64)
        start = [_seed(n_positives, of(q)[(slabel == labels[q]) & (sid != ids[q])]).beat for q in range(len(ids))]
        three = ids, labels, vectors

        def emit(q_best):
            n = [len(b.ids) for _, b in q_best]
            if sum(n):
                cat = lambda x, t: pa.array(np.concatenate(x).astype(t))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat([q for q, _ in q_best], n).astype(np.int64)), cat([b.ids for _, b in q_best], np.int64),
                     cat([b.scores for _, b in q_best], np.int64)], names=["q", "id", "score"])

        def positives(batches, three=three, start=start):
            first = [Best(n_positives, s) for s in start]
            positives_pass(batches, lambda b: Cells(b, light), three, first)
            yield from emit([*enumerate(first)])

        def ranked(df, k):
            w = Window.partitionBy("q").orderBy(F.col("score").desc(), "id")
            return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)

        got: list = [[] for _ in ids]
        for r in ranked(index.cells.mapInArrow(positives, "q long, id long, score long"), n_positives).sort("q", "rank").collect():
            got[r["q"]].append((r["id"], r["score"]))  # of this block's anchors
        scores = [[s for _, s in g] for g in got]
        floor = []
        for q in range(len(ids)):
            s = of(q)[slabel != labels[q]]
            floor.append([_seed(n_negatives, s[in_window(s, p)]).beat for p in scores[q]])

        def negatives(batches, three=three, scores=scores, floor=floor):
            first = [[Best(n_negatives, b) for b in row] for row in floor]
            negatives_pass(batches, lambda b: Cells(b, light), three, scores, first)
            yield from emit([(q * n_positives + j, b) for q, row in enumerate(first) for j, b in enumerate(row)])

        pairs = spark.createDataFrame(
            [(q * n_positives + j, int(ids[q]), p, s) for q, g in enumerate(got) for j, (p, s) in enumerate(g)],
            "w long, anchor_id long, positive_id long, positive_score long")
        found = ranked(index.cells.mapInArrow(negatives, "q long, id long, score long"), n_negatives)
        out = found.join(F.broadcast(pairs), F.col("q") == F.col("w")).select(
            "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
        done = out if done is None else done.union(out)
    if done is None:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    return done
