"""Vectors packed into blocks of rows: what every k-means pass reads.

A block is one row ``(slice, block, n, ids, off, idx, w)`` of binary columns: up to ``BLOCK_ROWS``
vectors in id order, dense (``w`` holds n x dim numbers) or sparse (row i has the entries
``off[i]:off[i+1]`` of ``idx`` and ``w``). A pass reads them without converting a value.

Sums over rows or terms are taken over integers: a term of a sum is rounded to a multiple of a fixed
step first, and sums of integers do not depend on their order. So every result that follows
(centroids, distances of sparse rows, running sums of the seeding) is the same on every physical path
and for every partitioning.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import counts as ct

BLOCK_ROWS = 2048
BLOCK_VALUES = 1 << 19  # values of a block
SPARSE_VALUES = 1 << 16  # entries of a block of sparse rows
TASK_VALUES = 1 << 22  # entries of a task's blocks, about
WEIGHT_STEP = 2.0 ** 36  # steps per unit of a TF-IDF weight (at most 1) in centroid sums
PRODUCT_STEP = 2.0 ** 48  # steps per unit of a product of two weights
TABLE_TERMS = 1 << 24  # terms of a lookup table (64 MB)
DIST_STEP = 2.0 ** 32  # steps per unit of a squared distance in running sums
BLOCK_SCHEMA = "slice int, block long, n int, ids binary, off binary, idx binary, w binary"
MASK = (1 << 32) - 1


def _cols(vec_col) -> list:
    return [vec_col] if isinstance(vec_col, str) else list(vec_col)


def _lists(column):
    """(values, offsets) of a list column of an Arrow batch; null lists are empty."""
    column = column.fill_null([]) if column.null_count else column
    off = column.offsets.to_numpy().astype(np.int64)
    return column.values.to_numpy(zero_copy_only=False)[off[0]:off[-1]], off - off[0]


def _blocks(part: int, k: int, ids, off, idx, w, values: int):
    """Rows of ``BLOCK_SCHEMA`` from block number ``k`` on; ``idx`` None: dense."""
    names = [c.split()[0] for c in BLOCK_SCHEMA.split(", ")]
    a = 0
    while a < len(ids):
        z = min(len(ids), a + BLOCK_ROWS, max(a + 1, int(np.searchsorted(off, off[a] + values, "right")) - 1))
        lo, hi = int(off[a]), int(off[z])
        raw = [np.ascontiguousarray(ids[a:z], "<i8"), np.ascontiguousarray(off[a:z + 1] - lo, "<i8"),
               np.empty(0, "<i4") if idx is None else np.ascontiguousarray(idx[lo:hi], "<i4"),
               np.ascontiguousarray(w[lo:hi], "<f8")]
        yield pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([k], pa.int64()), pa.array([z - a], pa.int32()),
             *[pa.array([x.tobytes()], pa.binary()) for x in raw]], names=names)
        a, k = z, k + 1


def pack(vectors: DataFrame, vec_col="vec", ordered: bool = True) -> DataFrame:
    """Blocks of ``vectors(idea_id, ...)``. ``ordered``: slices are ranges of ids, rows sorted by id."""
    sparse = not isinstance(vec_col, str)
    rows = vectors.select("idea_id", *_cols(vec_col))
    if ordered:
        p = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        rows = rows.repartitionByRange(p, "idea_id").sortWithinPartitions("idea_id")

    def run(batches):
        from pyspark import TaskContext

        part, k = TaskContext.get().partitionId(), 0
        for b in batches:
            idx, (w, off) = None, _lists(b.column(1))
            if sparse:
                idx, w = w, _lists(b.column(2))[0]
            for out in _blocks(part, k, b.column(0).to_numpy(), off, idx, w, SPARSE_VALUES if sparse else BLOCK_VALUES):
                yield out
                k += 1

    return rows.mapInArrow(run, BLOCK_SCHEMA)


def entry_rows(entries: DataFrame, spine: DataFrame) -> DataFrame:
    """``(idea_id, idx, w)`` per id of ``spine``: its ``entries(idea_id, idx, weight)`` by idx, packed as in a block.

    Weights come in partitioned by id, so their rows are put together where they are.
    """
    def row(key, t):
        idx, w = t.column("idx").to_numpy(), t.column("weight").to_numpy()
        order = np.argsort(idx)
        return pa.table([pa.array([key[0].as_py()], pa.int64()), pa.array([idx[order].astype("<i4").tobytes()], pa.binary()),
                         pa.array([w[order].astype("<f8").tobytes()], pa.binary())], names=["idea_id", "idx", "w"])

    rows = entries.select("idea_id", "idx", "weight").groupBy("idea_id").applyInArrow(row, "idea_id long, idx binary, w binary")
    return spine.select("idea_id").join(rows, "idea_id", "left")


def pack_rows(rows: DataFrame) -> DataFrame:
    """Ordered blocks of ``entry_rows``."""
    p = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(p, "idea_id").sortWithinPartitions("idea_id")

    def flat(column, kind):
        at = np.frombuffer(column.buffers()[1], "<i4")[column.offset:column.offset + len(column) + 1]
        data = column.buffers()[2]
        return np.frombuffer(data, np.uint8)[at[0]:at[-1]].view(kind) if data is not None else np.empty(0, kind)

    def run(batches):
        from pyspark import TaskContext

        part, k = TaskContext.get().partitionId(), 0
        for b in batches:
            idx, w = (c.fill_null(b"") for c in b.columns[1:])
            n = pc.fill_null(pc.binary_length(idx), 0).to_numpy(zero_copy_only=False).astype(np.int64) // 4
            for out in _blocks(part, k, b.column(0).to_numpy(), np.concatenate([[0], np.cumsum(n)]), flat(idx, "<i4"), flat(w, "<f8"), SPARSE_VALUES):
                yield out
                k += 1

    return rows.mapInArrow(run, BLOCK_SCHEMA)


def pack_counts(counts: DataFrame, vocab: ct.Vocabulary) -> DataFrame:
    """Ordered blocks of packed counts (``counts``), whose ``w`` holds, per row, tokens, length and squared length
    of the vector, and per entry the count: with the idf, which a task reads once, they give the weights."""
    spark = counts.sparkSession
    size = counts.agg(F.sum(F.octet_length("tfs"))).first()[0] or 0
    p = min(int(spark.conf.get("spark.sql.shuffle.partitions")), max(2 * spark.sparkContext.defaultParallelism, -(-size // (4 * TASK_VALUES))))
    rows = counts.select("idea_id", "n_tokens", "terms", "tfs").repartitionByRange(p, "idea_id").sortWithinPartitions("idea_id")
    names = [c.split()[0] for c in BLOCK_SCHEMA.split(", ")]

    def run(batches):
        from pyspark import TaskContext

        part, k, idf = TaskContext.get().partitionId(), 0, vocab.idf.value
        for b in batches:
            ids, n = b.column(0).to_numpy(), b.column(1).to_numpy()
            for lo, hi in ct.runs(b.column(3)):
                got = ct.weigh(ct.entries(b.column(2).slice(lo, hi - lo), b.column(3).slice(lo, hi - lo)), n[lo:hi], vocab)
                x2 = Rows(ids[lo:hi], got.off, got.idx, got.weights(idf), True).x2()
                a, off = 0, got.off
                while a < hi - lo:
                    z = min(hi - lo, a + BLOCK_ROWS, max(a + 1, int(np.searchsorted(off, off[a] + SPARSE_VALUES, "right")) - 1))
                    at = slice(int(off[a]), int(off[z]))
                    tf = got.tf[at]
                    tf = tf.astype("<u1" if tf.max(initial=0) < 256 else "<u4")
                    raw = [ids[lo + a:lo + z].astype("<i8").tobytes(), (off[a:z + 1] - off[a]).astype("<i8").tobytes(), got.idx[at].astype("<i4").tobytes(),
                           got.n[a:z].tobytes() + got.norm[a:z].tobytes() + x2[a:z].tobytes() + tf.tobytes()]
                    yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([k], pa.int64()), pa.array([z - a], pa.int32()),
                                                      *[pa.array([x], pa.binary()) for x in raw]], names=names)
                    a, k = z, k + 1

    return rows.mapInArrow(run, BLOCK_SCHEMA)


def unpack(blocks: DataFrame, idf=None) -> DataFrame:
    """The sparse rows ``(idea_id, idx array<int>, w array<double>)`` of blocks."""
    def run(batches):
        for _, x in rows_of(batches, True, idf):
            lists = [pa.ListArray.from_arrays(pa.array(x.off.astype(np.int32)), pa.array(v)) for v in (x.idx, x.w)]
            yield pa.RecordBatch.from_arrays([pa.array(x.ids), *lists], names=["idea_id", "idx", "w"])

    return blocks.mapInArrow(run, "idea_id long, idx array<int>, w array<double>")


class Rows:
    """The vectors of a block."""

    def __init__(self, ids, off, idx, w, sparse: bool, coded=None):
        self.ids, self.off, self.idx, self._w, self.sparse = ids, off, idx, w, sparse
        self.m = len(ids)
        self._x2, self.coded = (None, None) if coded is None else (coded[2], coded)  # tokens, length, x2, counts, idf

    @property
    def w(self) -> np.ndarray:
        if self._w is None:
            n, norm, _, tf, idf = self.coded
            self._w = ct.weights(self.off, self.idx, tf, n, norm, idf)
        return self._w

    def some(self, at: np.ndarray, row: np.ndarray) -> np.ndarray:
        """The values of the entries ``at`` of the rows ``row``."""
        if self._w is not None:
            return self._w[at]
        n, norm, _, tf, idf = self.coded
        return tf[at] / n[row] * idf[self.idx[at]] / norm[row]

    @classmethod
    def of(cls, row: dict, sparse: bool, idf=None) -> "Rows":
        ids = np.frombuffer(row["ids"], "<i8")
        if idf is not None:
            off, idx, m = np.frombuffer(row["off"], "<i8"), np.frombuffer(row["idx"], "<i4"), len(ids)
            own = np.frombuffer(row["w"], "<f8", 2 * m).reshape(2, m)
            x2 = np.frombuffer(row["w"], "<i8", m, 16 * m)
            tf = np.frombuffer(row["w"], "<u4" if len(row["w"]) - 24 * m == 4 * len(idx) else "<u1", len(idx), 24 * m)
            return cls(ids, off, idx, None, True, (own[0], own[1], x2, tf, idf))
        w = np.frombuffer(row["w"], "<f8")
        if not sparse:
            return cls(ids, None, None, w.reshape(len(ids), -1), False)
        return cls(ids, np.frombuffer(row["off"], "<i8"), np.frombuffer(row["idx"], "<i4"), w, True)

    def take(self, rows: np.ndarray) -> "Rows":
        if not self.sparse:
            return Rows(self.ids[rows], None, None, self.w[rows], False)
        n = (self.off[1:] - self.off[:-1])[rows]
        off = np.concatenate([[0], np.cumsum(n)])
        at = np.repeat(self.off[rows] - off[:-1], n) + np.arange(off[-1])
        if self._w is None:
            own, norm, x2, tf, idf = self.coded
            return Rows(self.ids[rows], off, self.idx[at], None, True, (own[rows], norm[rows], x2[rows], tf[at], idf))
        return Rows(self.ids[rows], off, self.idx[at], self.w[at], True)

    def vector(self, i: int, dim: int) -> np.ndarray:
        if not self.sparse:
            return self.w[i].astype(float)
        v = np.zeros(dim)
        v[self.idx[self.off[i]:self.off[i + 1]]] = self.w[self.off[i]:self.off[i + 1]]
        return v

    def entries(self, i: int):
        """(indices, values) of a sparse row."""
        return self.idx[self.off[i]:self.off[i + 1]].copy(), self.w[self.off[i]:self.off[i + 1]].copy()

    def to_row(self, idx: np.ndarray, w: np.ndarray, dim: int | None = None, held: dict | None = None) -> np.ndarray:
        """Squared distances of the sparse rows to one sparse row (indices ascending). ``held`` keeps the table of
        its ``dim`` terms for the next rows."""
        top = dim if dim is not None else int(max(idx.max(initial=0), self.idx.max(initial=0))) + 1
        if top <= TABLE_TERMS:
            held = {} if held is None else held
            if "table" not in held:
                held["table"] = np.zeros(top, np.int32)
                held["table"][idx] = np.arange(1, len(idx) + 1)
            at = held["table"][self.idx] - 1
            both = np.flatnonzero(at >= 0)
        else:
            at = np.searchsorted(idx, self.idx)
            both = np.flatnonzero(np.append(idx, -1)[at] == self.idx)
        row = np.repeat(np.arange(self.m), np.diff(self.off))[both]
        q = np.rint(w[at[both]] * self.some(both, row) * PRODUCT_STEP)
        dots = np.bincount(row, q, self.m).astype(np.int64)
        own = int(np.rint(w * w * PRODUCT_STEP).astype(np.int64).sum())
        return np.maximum(self.x2() - 2 * dots + own, 0) / PRODUCT_STEP

    def x2(self) -> np.ndarray:
        """Squared lengths of sparse rows, in product steps."""
        if self._x2 is None:
            q = np.rint(self.w * self.w * PRODUCT_STEP).astype(np.int64)
            total = np.concatenate([[0], np.cumsum(q)])
            self._x2 = total[self.off[1:]] - total[self.off[:-1]]
        return self._x2

    def dots(self, C: np.ndarray) -> np.ndarray:
        """Products of the sparse rows with the rows of ``C``, in product steps (m x k)."""
        k = C.shape[0]
        out, step = np.zeros((self.m, k), np.int64), max(1, (1 << 21) // k)
        ct = np.ascontiguousarray(C.T)
        a = 0
        while a < self.m:
            z = max(a + 1, int(np.searchsorted(self.off, self.off[a] + step, "right")) - 1)
            lo, hi = int(self.off[a]), int(self.off[z])
            n = self.off[a + 1:z + 1] - self.off[a:z]
            full = np.flatnonzero(n)
            if len(full):
                q = ct[self.idx[lo:hi]]
                q *= (self.w[lo:hi] * PRODUCT_STEP)[:, None]  # a power of two: no rounding of its own
                np.rint(q, out=q)  # whole numbers: their sums are exact below 2 ** 53
                out[a + full] = np.add.reduceat(q, self.off[a:z][full] - lo, axis=0)
            a = z
        return out

    def _top(self, width: int):
        """(row of each entry; which entries have a term below ``width``)."""
        return np.repeat(np.arange(self.m), np.diff(self.off)), self.idx < width

    def _rare(self, entries: np.ndarray, rare, width: int, k: int):
        """Pairs (entry, cell) of the entries whose term has cells in ``rare`` (starts of terms from ``width`` on, clusters, values)."""
        start, cluster, value = rare
        t = self.idx[entries] - width
        n = start[t + 1] - start[t]
        step = max(1, (1 << 21) // k)
        for a in range(0, len(entries), step):
            m = n[a:a + step]
            ends = np.cumsum(m)
            if len(m) and ends[-1]:
                at = np.repeat(start[t[a:a + step]] - ends + m, m) + np.arange(ends[-1])
                yield np.repeat(entries[a:a + step], m), cluster[at], value[at]

    def dots_sliced(self, top: np.ndarray, rare, k: int) -> np.ndarray:
        """``dots`` with the centroids' first terms as a (terms x k) matrix and the cells of the others (``_rare``)."""
        width, out = len(top), np.zeros((self.m, k), np.int64)
        row, low = self._top(width)
        at, step = np.flatnonzero(low), max(1, (1 << 17) // k)
        for a in range(0, len(at), step):
            e = at[a:a + step]
            q = top[self.idx[e]]
            q *= (self.w[e] * PRODUCT_STEP)[:, None]
            np.rint(q, out=q)
            r = row[e]
            first = np.flatnonzero(np.diff(r, prepend=-1))
            out[r[first]] += np.add.reduceat(q, first, axis=0).astype(np.int64)
        for e, c, v in self._rare(np.flatnonzero(~low), rare, width, k):  # whole numbers: their sums are exact below 2 ** 53
            out += np.bincount(row[e] * k + c, np.rint(v * (self.w[e] * PRODUCT_STEP)), self.m * k).reshape(self.m, k).astype(np.int64)
        return out

    def own_dots(self, top: np.ndarray, rare, k: int, label: np.ndarray) -> np.ndarray:
        """The column ``label`` of ``dots_sliced`` for each row."""
        row, low = self._top(len(top))
        at = np.flatnonzero(low)
        r = row[at]
        q = np.rint(top[self.idx[at], label[r]] * (self.w[at] * PRODUCT_STEP))
        out = np.bincount(r, q, self.m).astype(np.int64)
        for e, c, v in self._rare(np.flatnonzero(~low), rare, len(top), k):
            own = c == label[row[e]]
            e, v = e[own], v[own]
            out += np.bincount(row[e], np.rint(v * (self.w[e] * PRODUCT_STEP)), self.m).astype(np.int64)
        return out

    def products(self, top: np.ndarray, rare, k: int) -> np.ndarray:
        """``dots_sliced`` in floats, not in steps (m x k): a row's first terms (indices ascend) at a time."""
        width, out, step = len(top), np.zeros((self.m, k)), max(1, (1 << 21) // k)
        if not len(self.idx):
            return out
        row, low = self._top(width)
        ends = self.off[:-1] + np.bincount(row[low], minlength=self.m)
        w, at = self.w, self.idx.astype(np.intp)
        held = np.empty((min(step, int((ends - self.off[:-1]).max())), k))
        for r, a, z in zip(range(self.m), self.off.tolist(), ends.tolist()):
            if a < z <= a + step:
                np.dot(w[a:z], top.take(at[a:z], 0, held[:z - a], "clip"), out[r])
            else:
                for i in range(a, z, step):
                    j = min(z, i + step)
                    out[r] += w[i:j] @ top.take(at[i:j], 0, held[:j - i], "clip")
        for e, c, v in self._rare(np.flatnonzero(~low), rare, width, k):
            out += np.bincount(row[e] * k + c, v * w[e], self.m * k).reshape(self.m, k)
        return out

    def squared(self, C: np.ndarray, c2: np.ndarray | None = None) -> np.ndarray:
        """Squared distances to the rows of ``C`` (m x k)."""
        if self.sparse:
            steps = self.x2()[:, None] - 2 * self.dots(C) + (c2 if c2 is not None else squares(C))[None, :]
            return np.maximum(steps, 0) / PRODUCT_STEP
        out = np.empty((self.m, len(C)))
        for c in range(len(C)):
            diff = self.w - C[c]
            out[:, c] = np.einsum("ij,ij->i", diff, diff)
        return out

    def nearest(self, C: np.ndarray, c2: np.ndarray | None = None):
        """(index of the nearest row of ``C``, ties to the lowest; its squared distance)."""
        d = self.squared(C, c2)
        best = d.argmin(axis=1)
        return best, d[np.arange(self.m), best]


def by_slice(idx: np.ndarray, width: int):
    """(slice, positions of its entries in their order) of every slice of ``width`` terms that has entries."""
    part = idx // width
    n = int(part.max(initial=0)) + 1
    order = np.argsort(part.astype(np.uint16 if n <= 1 << 16 else np.int64), kind="stable") if n > 1 else np.arange(len(idx))
    ends = np.concatenate([[0], np.cumsum(np.bincount(part, minlength=n))])
    for s in np.flatnonzero(np.diff(ends)).tolist():
        yield s, order[ends[s]:ends[s + 1]]


def squares(C: np.ndarray) -> np.ndarray:
    """Squared lengths of centroids, in product steps."""
    return np.rint(C * C * PRODUCT_STEP).astype(np.int64).sum(axis=1)


def rows_of(batches, sparse: bool, idf=None):
    """(slice, block, ``Rows``) of every block of the batches; ``idf``: the broadcast that goes with ``pack_counts``."""
    for b in batches:
        cols = {n: c.to_pylist() for n, c in zip(b.schema.names, b.columns)}
        for i in range(b.num_rows):
            row = {n: c[i] for n, c in cols.items()}
            yield row, Rows.of(row, sparse, None if idf is None else idf.value)


def add_steps(total: np.ndarray, label: np.ndarray, x: Rows, step: float) -> None:
    """Adds the rows, in steps, to ``total[label]`` (k x dim integers)."""
    if x.sparse:
        flat = np.repeat(label, np.diff(x.off)) * total.shape[1] + x.idx
        np.add.at(total.reshape(-1), flat, np.rint(x.w * step).astype(np.int64))
    else:
        q = np.rint(x.w * step).astype(np.int64)
        order = np.argsort(label, kind="stable")
        have, first = np.unique(label[order], return_index=True)
        total[have] += np.add.reduceat(q[order], first, axis=0)


def halves(q: np.ndarray):
    """Upper and lower 32 bits of integers: sums of both cannot overflow where the sum would."""
    return q >> 32, q & MASK


def from_halves(high, low) -> np.ndarray:
    return np.asarray(high, float) * 4294967296.0 + np.asarray(low, float)


def steps_sum(value, name: str):
    """The two sums behind ``from_halves`` as columns ``<name>_hi`` and ``<name>_lo``."""
    return [F.sum(F.shiftright(value, 32)).alias(f"{name}_hi"), F.sum(value.bitwiseAND(F.lit(MASK))).alias(f"{name}_lo")]


def mixed(ids: np.ndarray, salt) -> np.ndarray:
    """64-bit hash of (id, salt)."""
    with np.errstate(over="ignore"):
        h = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + (np.asarray(salt).astype(np.uint64) + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


def digest(ids: np.ndarray, label: np.ndarray) -> int:
    """Exclusive or of the hashes of (id, label): equal labellings have equal digests, in any order."""
    return int(np.bitwise_xor.reduce(mixed(ids, label), initial=np.uint64(0)).astype(np.int64))
