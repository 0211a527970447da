"""SimHash near-duplicates with a Gray-order hierarchical index.

Fingerprints: 64 majority bits over the XXH64 values of word shingles. Links: at most ``distance``
differing bits. Distinct fingerprints are dealt to ``distance + 1`` tables by a mask of the bits
each (two fingerprints that link agree on one mask entirely), so a bucket shares one masked
pattern: the top node of an index. A bucket of more than ``BUCKET`` members is dealt again by masks of
its free bits in the same way; what is still larger is cut into blocks in Gray order, and every pair
of blocks whose common bits allow a link is looked at on its own, so no task gets a larger group.
Inside a bucket the fingerprints are sorted by Gray rank and
cut into groups of ``FAN``; the bits on which a group agrees form its node (mask, pattern), groups
of groups the nodes above. Pairs of nodes are followed downwards only while the differing bits of
their common masked patterns stay within the distance; a node whose members differ in few enough
bits altogether is linked as a whole. A bucket returns a spanning forest of its links, so large
groups of near copies cost edges in proportion to their members. Components are found by
alternating star contraction over these edges, in tables.

Defined results: a null or wordless text has fingerprint zero and links like any other; a null id
is never the smallest of a component unless all its ids are null; repeated rows are members like
others; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

SHINGLE = 4
DISTANCE = 4
SEED = 42
FAN = 16
PAIR_CHUNK = 1 << 20
BUCKET = 4096  # members that one index takes at most
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64 bits, each set if it is set in over half the shingles' hashes."""
    words = _WORD.findall(text.encode("utf-8", "replace").lower()) if text else []
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    begins = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - shingle + 1)
    h64 = xxhash.xxh64_intdigest
    last = ends[min(shingle, len(words)) - 1:].tolist()
    h = np.fromiter((h64(line[a:b], SEED) for a, b in zip(begins[:n].tolist(), last)), np.uint64, n)
    counts = np.zeros(64, np.int64)
    for lo in range(0, n, 8192):  # bounded memory for very long texts
        bits = np.unpackbits(h[lo:lo + 8192].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(sum(1 << i for i in range(64) if 2 * counts[i] > n))


def fingerprints(df: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``(id, fp)`` per row; ``fp`` is the fingerprint as a signed long."""
    def run(batches):
        for b in batches:
            fp = np.array([fingerprint(v.as_py(), shingle) for v in b.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp, pa.int64()), b.column(2)], names=["id", "fp", "key"])

    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(df[id_col].alias("id"), df[text].alias("text"), F.xxhash64(df[text]).alias("key"))
    return rows.mapInArrow(run, f"id {kind}, fp long, key long")


def masks(distance: int = DISTANCE) -> list[int]:
    """``distance + 1`` masks that part the 64 bits."""
    edges = np.linspace(0, 64, distance + 2).astype(int).tolist()
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Place of each value in reflected Gray order."""
    x = x.copy()
    for s in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(s)
    return x


class GrayIndex:
    """Nodes over Gray-sorted fingerprints; ``links`` returns a spanning forest of those within the distance."""

    def __init__(self, values: np.ndarray, distance: int, fan: int = FAN):
        self.v = values[np.argsort(gray_rank(values), kind="stable")]
        self.k, self.fan = distance, fan
        every, none = self.v, self.v
        self.levels = [(every, none)]  # (AND, OR) of the members of each node
        while len(every) > fan:
            cut = np.arange(0, len(every), fan)
            every, none = np.bitwise_and.reduceat(every, cut), np.bitwise_or.reduceat(none, cut)
            self.levels.append((every, none))
        self.parent = np.arange(len(self.v))

    def _root(self, i: int) -> int:
        p = self.parent
        while p[i] != i:
            p[i] = p[p[i]]
            i = p[i]
        return i

    def _join(self, a: int, b: int) -> None:
        a, b = self._root(a), self._root(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)

    def _flat(self) -> np.ndarray:
        p = self.parent
        while True:
            q = p[p]
            if (q == p).all():
                return p
            p = self.parent = q

    def links(self) -> list[tuple[int, int]]:
        top = len(self.levels) - 1
        n = len(self.levels[top][0])
        a, b = np.triu_indices(n)
        todo = [(top, a, b)]
        while todo:
            level, a, b = todo.pop()
            most = PAIR_CHUNK if level == 0 else PAIR_CHUNK // self.fan ** 2  # children stay within memory
            if len(a) > most:
                todo += [(level, a[i:i + most], b[i:i + most]) for i in range(0, len(a), most)]
                continue
            every, some = self.levels[level]
            if level == 0:
                near = (a != b) & (_popcount(self.v[a] ^ self.v[b]) <= self.k)
                self._union(a[near], b[near])
                continue
            # bits that all members of one node have and all of the other lack, or the reverse
            span = self.fan ** level
            p, cut = self._flat(), np.arange(0, len(self.v), span)
            low, high = np.minimum.reduceat(p, cut), np.maximum.reduceat(p, cut)
            new = (low[a] != high[a]) | (low[b] != high[b]) | (low[a] != low[b])  # not yet one component
            a, b = a[new], b[new]
            apart = (every[a] & ~some[b]) | (every[b] & ~some[a])
            near = _popcount(apart) <= self.k
            a, b = a[near], b[near]
            # nodes whose members all lie within the distance: linked as a whole
            tight = _popcount((some[a] | some[b]) & ~(every[a] & every[b])) <= self.k
            for x, y in zip(a[tight].tolist(), b[tight].tolist()):
                first = x * span
                for node in {x, y}:
                    members = np.arange(node * span, min((node + 1) * span, len(self.v)))
                    self._union(np.full(len(members), first), members)
            a, b = a[~tight], b[~tight]
            if not len(a):
                continue
            below = len(self.levels[level - 1][0])
            step = np.arange(self.fan)
            ca = (a[:, None] * self.fan + step)[:, :, None].repeat(self.fan, 2).reshape(-1)
            cb = (b[:, None] * self.fan + step)[:, None, :].repeat(self.fan, 1).reshape(-1)
            keep = (ca <= cb) & (ca < below) & (cb < below)
            todo.append((level - 1, ca[keep], cb[keep]))
        p = self._flat()
        return [(int(self.v[i]), int(self.v[r])) for i, r in enumerate(p.tolist()) if i != r]

    def _union(self, a: np.ndarray, b: np.ndarray) -> None:
        p = self._flat()
        open_ = p[a] != p[b]
        for x, y in zip(a[open_].tolist(), b[open_].tolist()):
            self._join(x, y)


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def further_masks(mask: int, distance: int = DISTANCE) -> list[int]:
    """``mask`` with each of ``distance + 1`` parts of its free bits."""
    free = [i for i in range(64) if not mask >> i & 1]
    return [mask | sum(1 << int(i) for i in part) for part in np.array_split(free, distance + 1)]


def link_forest(distinct: DataFrame, distance: int = DISTANCE, most: int = BUCKET) -> DataFrame:
    """Edges ``(u, v)`` that connect all fingerprints (column ``fp``) within ``distance`` bits.

    No index takes more than ``most`` members (at least 2); the edges connect the same whatever it is.
    """
    parts = masks(distance)
    # the mask's number and the masked pattern are the top node of the bucket's index
    buckets = F.explode(F.array(*[F.struct(F.lit(i).cast("long").alias("m"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("pattern"))
                                  for i, m in enumerate(parts)])).alias("b")
    dealt = distinct.select("fp", buckets).select("fp", F.col("b.m").alias("m"), F.col("b.pattern").alias("pattern"))
    p = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = ["m", "pattern"]

    def links(rows: DataFrame) -> DataFrame:
        def run(batches):
            held, now = [], None

            def found():
                fp = np.concatenate(held)
                return GrayIndex(fp.view(np.uint64), distance).links() if len(fp) > 1 else []

            def edges(out):
                e = np.array(out, np.uint64).reshape(-1, 2).view(np.int64)
                return pa.RecordBatch.from_arrays([pa.array(e[:, 0]), pa.array(e[:, 1])], names=["u", "v"])

            for batch in batches:
                if not batch.num_rows:
                    continue
                fp, m, pat = (batch.column(i).to_numpy() for i in range(3))
                cut = np.flatnonzero(np.r_[True, (m[1:] != m[:-1]) | (pat[1:] != pat[:-1])])
                out: list = []
                for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(fp)]):
                    if held and now != (m[a], pat[a]):
                        out += found()
                        held = []
                    now = m[a], pat[a]
                    held.append(fp[a:b].copy())
                yield edges(out)
            if held:
                yield edges(found())

        return rows.repartition(p, *key).sortWithinPartitions(*key).mapInArrow(run, "u long, v long")

    def split(rows: DataFrame):
        """(links of the buckets that fit, rows of the larger ones or None)."""
        # at most one row for each ``most`` members
        hot = materialise(rows.groupBy(*key).agg(F.count("*").alias("n")).where(F.col("n") > most).select(*key), "sim-hot")
        if not hot.limit(1).count():
            return links(rows), None
        return links(rows.join(F.broadcast(hot), key, "left_anti").select("fp", *key)), \
            rows.join(F.broadcast(hot), key, "left_semi").select("fp", *key)

    done, large = split(dealt)
    if large is None:
        return done
    table = F.array(*[F.array(*[F.lit(_signed(x)) for x in further_masks(m, distance)]) for m in parts])
    again = (large.select("fp", "m", F.posexplode(F.element_at(table, F.col("m").cast("int") + 1)).alias("s", "mask"))
             .select("fp", (F.col("m") * (distance + 1) + F.col("s")).alias("m"), F.col("fp").bitwiseAND(F.col("mask")).alias("pattern")))
    more, large = split(again)
    done = done.union(more)
    return done if large is None else done.union(links(_block_pairs(large, distance, max(1, most // 2), p)))


def _block_pairs(rows: DataFrame, distance: int, size: int, p: int) -> DataFrame:
    """``(fp, m, pattern)`` with buckets cut into blocks of ``size`` in Gray order: ``m`` and ``pattern`` of
    the result name a pair of blocks that may hold a link."""
    gray = F.col("fp")
    for s in (1, 2, 4, 8, 16, 32):
        gray = gray.bitwiseXOR(F.shiftrightunsigned(gray, s))

    def number(batches):
        k, n, now = TaskContext.get().partitionId() << 32, 0, None
        for b in batches:
            blocks = []
            for at in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                if at != now or n >= size:
                    k, n, now = k + 1, 0, at
                n += 1
                blocks.append(k)
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(blocks, pa.int64())], names=["fp", "m", "pattern", "block"])

    order = ["m", "pattern", "gray"]
    blocks = materialise(rows.withColumn("gray", gray).repartitionByRange(p, *order).sortWithinPartitions(*order)
                         .mapInArrow(number, "fp long, m long, pattern long, block long"), "sim-blocks")
    nodes = blocks.groupBy("m", "pattern", "block").agg(F.bit_and("fp").alias("every"), F.bit_or("fp").alias("some"))
    a, b = (nodes.select("m", "pattern", *[F.col(c).alias(f"{c}_{t}") for c in ("block", "every", "some")]) for t in "ab")
    apart = "bit_count((every_a & ~some_b) | (every_b & ~some_a))"
    pairs = a.join(b, ["m", "pattern"]).where("block_a <= block_b").where(f"{apart} <= {distance}")
    each = pairs.select(F.explode(F.array_distinct(F.array("block_a", "block_b"))).alias("block"), "block_a", "block_b")
    return blocks.select("fp", "block").join(each, "block").select(
        "fp", F.col("block_a").alias("m"), F.col("block_b").alias("pattern"))


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges`` (u, v): root is the smallest node it is connected to.

    Alternating stars: every node hangs its larger neighbours on its smallest neighbour, then its
    smaller ones; the forest is flat when neither step changes the edge table.
    """
    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        if not large:
            both = both.where("v < u")
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        j = both.join(low, "u")
        if large:
            new = j.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            new = (j.select(F.col("v").alias("u"), F.col("m").alias("v"))
                   .union(low.select("u", F.col("m").alias("v"))))
        return new.where("u <> v").distinct()

    def mark(e: DataFrame):
        r = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        return r["n"], r["s"]

    e = materialise(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
                    "sim-edges")
    was = mark(e)
    while was[0]:
        e = materialise(star(star(e, True), False), "sim-edges")
        now = mark(e)
        if now == was:
            break
        was = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    distance: int = DISTANCE) -> DataFrame:
    """``(id, key, fp, root, component_id)`` per row: ``key`` is a hash of the text, ``root`` names the
    group, ``component_id`` is its smallest id."""
    docs = materialise(fingerprints(df, id_col, text, shingle), "sim-docs")
    # one row per distinct fingerprint first: copies meet in partial aggregates
    low = docs.groupBy("fp").agg(F.min("id").alias("low"))
    groups = components(link_forest(low.select("fp"), distance))
    rooted = materialise(low.join(groups, low["fp"] == groups["node"], "left")
                         .select("fp", F.coalesce("root", "fp").alias("root"), "low"), "sim-roots")
    least = materialise(rooted.groupBy("root").agg(F.min("low").alias("component_id")), "sim-least")
    # both sides of each join are stored tables, so that a group of any size is split where they meet
    named = materialise(rooted.join(least, "root").select("fp", "root", "component_id"), "sim-named")
    return docs.join(named, "fp").select("id", "key", "fp", "root", "component_id")


def keep_one(df: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
             distance: int = DISTANCE) -> DataFrame:
    """Rows of ``df``, one of each group: the smallest id (then the smallest text hash) stays."""
    found = near_duplicates(df, id_col, text, shingle, distance)
    pick = F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("key").alias("key"))
    stay = materialise(found.groupBy("root").agg(F.min(pick).alias("x"), F.count("*").alias("n"))
                       .select(F.col("x.id").alias("kid"), F.col("x.key").alias("kkey")), "sim-keep")
    kept = df.join(stay, df[id_col].eqNullSafe(stay["kid"]) & (F.xxhash64(df[text]) == stay["kkey"]), "left_semi")
    # rows that repeat both id and text are one document
    again = (found.groupBy("id", "key").agg(F.count("*").alias("n")).where("n > 1")
             .join(stay, F.col("id").eqNullSafe(F.col("kid")) & (F.col("key") == F.col("kkey")), "left_semi"))
    return kept.dropDuplicates([id_col, text]) if again.limit(1).count() else kept
