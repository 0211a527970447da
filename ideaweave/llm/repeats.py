"""Which stretches of texts can hold a repeated window, and what to make of the answer.

Both substring operators ask for windows of ``size`` units (bytes or words) that occur elsewhere.
Two equal windows select the same anchor, the gram of smallest hash inside them, so a text is cut
into segments of windows with a common anchor and only segments whose anchor occurs twice or more
matter. Equal segments are counted and looked at once. What is left -- different segments with a
common anchor -- goes to the operator's own search, all segments of an anchor to one task; anchors
with more than ``HOT`` different segments are compared window by window in a grouped count instead,
so no task holds more than a bounded group. No step drops a window that could be repeated.

Texts are known by a 128-bit hash; equal texts share one result, which is joined back to all rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

HOT = 2000
SLICES = 1024
PART_BYTES = 1 << 20
_M = 0x9E3779B97F4A7C15


@dataclass(frozen=True)
class Units:
    """How a text is read: ``split(text)`` gives its bytes and the begin and end of each unit."""

    size: int  # units in a window
    gram: int  # units in an anchor
    split: Callable  # text -> (bytes, begins, ends)
    codes: Callable  # (bytes, begins, ends) -> uint64 per unit, equal for equal units


def poly(codes: np.ndarray, width: int, base: int = _M) -> np.ndarray:
    """Polynomial hash (mod 2**64) of every run of ``width`` codes."""
    out, done, mod = None, 0, 1 << 64
    power, span, mult = codes, 1, base
    with np.errstate(over="ignore"):
        while True:  # binary powers of the span
            if width >> (span.bit_length() - 1) & 1:
                if out is None:
                    out, done = power, span
                else:
                    n = len(codes) - done - span + 1
                    out = out[:n] * np.uint64(mult) + power[done:done + n]
                    done += span
            if span * 2 > width:
                return out
            power = power[:-span] * np.uint64(mult) + power[span:]
            mult = mult * mult % mod
            span *= 2


def mixed(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(29))


def anchors(codes: np.ndarray, size: int, gram: int):
    """(anchor hash, first window, last window, anchor position) of each segment of a text."""
    h = mixed(poly(codes, gram))
    # the smallest upper half of a hash, leftmost first; the same bits in texts of every length, or
    # equal windows of a short and a long text could choose different grams
    low = np.uint64((1 << 32) - 1)
    m = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    span, width = 1, size - gram + 1
    while span * 2 <= width:
        m = np.minimum(m[:-span], m[span:])
        span *= 2
    if span < width:
        m = np.minimum(m[:len(m) - (width - span)], m[width - span:])
    at = (m & low).astype(np.int64)
    cut = np.flatnonzero(at[1:] != at[:-1]) + 1
    first = np.concatenate([[0], cut])
    last = np.concatenate([cut, [len(at)]]) - 1
    return h[at[first]].view(np.int64), first, last, at[first]


def keyed(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """``(id, text, k1, k2)``: null texts are empty, the keys are a 128-bit hash of the text."""
    t = F.coalesce(df[text], F.lit(""))
    return df.select(df[id_col].alias("id"), t.alias("text"),
                     F.xxhash64(t).alias("k1"), F.xxhash64(F.lit(1), t).alias("k2"))


def segments(docs: DataFrame, units: Units) -> DataFrame:
    """One row per segment of every text: anchor, digest, length, place and ``n``, the rows of this
    batch that have the text (equal texts of a batch are cut once)."""
    size = units.size

    def run(batches):
        for b in batches:
            out: list[list] = [[] for _ in range(7)]
            keys = Counter(zip(b.column(1).to_pylist(), b.column(2).to_pylist()))
            for k1, k2, v in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(0)):
                times = keys.pop((k1, k2), 0)
                if not times:
                    continue
                data, begin, end = units.split(v.as_py())
                if len(begin) < size:
                    continue
                codes = units.codes(data, begin, end)
                h, first, last, _ = anchors(codes, size, units.gram)
                a, z = begin[first].tolist(), end[last + size - 1].tolist()
                out[0].append(h)
                out[1].append(np.fromiter((xxhash.xxh3_64_intdigest(data[x:y]) for x, y in zip(a, z)), np.uint64, len(a)).view(np.int64))
                out[2].append((last - first + size).astype(np.int32))
                out[3].append(first.astype(np.int32))
                for column, value in zip(out[4:], (k1, k2, times)):
                    column.append(np.full(len(a), value, np.int64))
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out],
                                                 names=["anchor", "seg", "len", "at", "k1", "k2", "n"])

    return docs.select("text", "k1", "k2").mapInArrow(
        run, "anchor long, seg long, len int, at int, k1 long, k2 long, n long")


SPANS = "anchor long, seg long, len int, spans array<struct<start:int,end:int>>"
_SPAN = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def runs(starts: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Maximal runs covered by windows that begin at the sorted ``starts``."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > size)
    a = starts[np.concatenate([[0], cut + 1])]
    b = starts[np.concatenate([cut, [len(starts) - 1]])] + size
    return list(zip(a.tolist(), b.tolist()))


def repeated_spans(docs: DataFrame, units: Units, search: Callable[[list[bytes]], Iterable[np.ndarray]]) -> DataFrame:
    """``(k1, k2, found)``: per text with repeats, the covered unit ranges as ``(at, spans)`` pairs.

    ``search(pieces)`` gets the bytes of different segments and returns, for each, the sorted
    window starts (in units) whose window also starts at another place among the pieces.
    """
    spark, size = docs.sparkSession, units.size
    occ = materialise(segments(docs, units), "seg")
    # a common anchor is dealt out in slices of at most about 1 / SLICES of all rows; the anchors with
    # more than one slice are SLICES at most, so their table is small whatever the input
    rows = max(occ.count(), 1)
    twice = materialise(occ.groupBy("anchor").agg(F.sum("n").alias("c"), F.count("*").alias("places")).where("c > 1")
                        .select("anchor", F.ceil(F.col("places") * SLICES / F.lit(rows)).cast("int").alias("slices")), "seg-twice")
    common = F.broadcast(twice.where("slices > 1"))
    dealt = (occ.join(common, "anchor", "left")
             .withColumn("slice", F.pmod(F.xxhash64("k1", "k2", "at"), F.coalesce("slices", F.lit(1))).cast("int")).drop("slices"))
    sliced = twice.select("anchor", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"))
    # a place in a text has one segment, so the anchor need not be a key
    places = materialise(dealt.join(sliced, ["anchor", "slice"]).groupBy("k1", "k2", "at")
                         .agg(F.min("anchor").alias("anchor"), F.min("seg").alias("seg"), F.min("len").alias("len"),
                              F.sum("n").alias("n")), "seg-places")
    kinds = places.groupBy("anchor", "seg", "len").agg(
        F.sum("n").alias("n"), F.min(F.struct("k1", "k2", "at")).alias("loc"))
    per_anchor = kinds.groupBy("anchor").agg(F.count("*").alias("kinds"))
    kinds = materialise(kinds.join(per_anchor, "anchor"), "seg-kinds")

    whole = F.array(F.struct(F.lit(0).alias("start"), F.col("len").alias("end")))
    alone = kinds.where("kinds = 1").select("anchor", "seg", "len", whole.alias("spans"))

    # bytes of the segments that differ but share an anchor, from one row of each text
    asked = (kinds.where("kinds > 1")
             .groupBy(F.col("loc.k1").alias("r1"), F.col("loc.k2").alias("r2"))
             .agg(F.collect_list(F.struct("anchor", "seg", "len", F.col("loc.at").alias("at"), "n",
                                          (F.col("kinds") > HOT).alias("hot"))).alias("want")))
    one = (docs.groupBy(F.col("k1").alias("d1"), F.col("k2").alias("d2")).agg(F.min("id").alias("rid"))
           .join(asked, (F.col("d1") == F.col("r1")) & (F.col("d2") == F.col("r2")))
           .select("r1", "r2", "rid", "want"))
    holders = docs.join(one, (F.col("k1") == F.col("r1")) & (F.col("k2") == F.col("r2"))
                        & F.col("id").eqNullSafe(F.col("rid"))).select("text", "want")

    def extract(batches):
        names = ["anchor", "seg", "len", "n", "off", "w1", "w2", "data"]
        kind = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
        signed = lambda x: x - (1 << 64) if x >> 63 else x
        for b in batches:
            rows, held = [], 0
            for v, want in zip(b.column(0), b.column(1)):
                data, begin, end = units.split(v.as_py())
                for w in want.as_py():
                    at, n = w["at"], w["len"]
                    if not w["hot"]:
                        rows.append((w["anchor"], w["seg"], n, w["n"], 0, 0, 0, data[begin[at]:end[at + n - 1]]))
                        held += len(rows[-1][-1])
                    else:
                        for o in range(n - size + 1):
                            x = xxhash.xxh3_128_intdigest(data[begin[at + o]:end[at + o + size - 1]])
                            rows.append((w["anchor"], w["seg"], n, w["n"], o, signed(x >> 64), signed(x & (1 << 64) - 1), None))
                    if held > 8 << 20 or len(rows) > 50_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kind)], names=names)
                        rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kind)], names=names)

    pieces = materialise(holders.mapInArrow(
        extract, "anchor long, seg long, len int, n long, off int, w1 long, w2 long, data binary"), "seg-pieces")

    cold = pieces.where("data is not null")
    total = cold.agg(F.sum(F.length("data"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // PART_BYTES))

    def groups(batches):
        """Answers for batches of whole anchor groups of bounded size."""
        rows = [r for b in batches for r in zip(*[c.to_pylist() for c in b.columns])]
        unique = {(r[0], r[1], r[2]): (r[3], r[4]) for r in rows}  # rows that repeat id and text come twice
        order, lo = sorted(unique), 0
        while lo < len(order):
            hi, held = lo, 0
            while hi < len(order) and (held < PART_BYTES or order[hi][0] == order[hi - 1][0]):
                held += len(unique[order[hi]][1])
                hi += 1
            part = order[lo:hi]
            found = search([unique[k][1] for k in part])
            spans = []
            for k, starts in zip(part, found):
                got = [(0, k[2])] if unique[k][0] > 1 else runs(starts, size)
                spans.append([{"start": a, "end": z} for a, z in got])
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in part], pa.int64()), pa.array([k[1] for k in part], pa.int64()),
                 pa.array([k[2] for k in part], pa.int32()), pa.array(spans, _SPAN)],
                names=["anchor", "seg", "len", "spans"])
            lo = hi

    searched = (cold.select("anchor", "seg", "len", "n", "data").repartition(int(parts), "anchor")
                .mapInArrow(groups, SPANS).where(F.size("spans") > 0))

    # anchors with very many different segments: equal windows are counted by their 128-bit hash
    hot = pieces.where("data is null").dropDuplicates(["anchor", "seg", "len", "off"])
    again = hot.groupBy("w1", "w2").agg(F.sum("n").alias("c")).where("c > 1").select("w1", "w2")
    windows = (hot.join(again, ["w1", "w2"]).groupBy("anchor", "seg", "len")
               .agg(F.sort_array(F.collect_set(F.struct(F.col("off").alias("start"), (F.col("off") + size).alias("end")))).alias("spans")))

    covered = alone.union(searched).union(windows.select("anchor", "seg", "len", "spans"))
    return (places.select("anchor", "seg", "len", "k1", "k2", "at").join(covered, ["anchor", "seg", "len"])
            .groupBy(F.col("k1").alias("s1"), F.col("k2").alias("s2"))
            .agg(F.collect_list(F.struct("at", "spans")).alias("found")))


def with_found(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``(id, text, found)`` for every row (found null: no repeats)."""
    return docs.join(spans, (F.col("k1") == F.col("s1")) & (F.col("k2") == F.col("s2")), "left").select("id", "text", "found")


def merged_ranges(found) -> list[tuple[int, int]]:
    """Maximal covered unit ranges of a text from its ``(at, spans)`` pairs."""
    out: list[list[int]] = []
    for a, z in sorted((f["at"] + s["start"], f["at"] + s["end"]) for f in found or [] for s in f["spans"]):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], z)
        else:
            out.append([a, z])
    return [(a, z) for a, z in out]
