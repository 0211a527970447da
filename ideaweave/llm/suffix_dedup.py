"""Exact substring removal by suffix sorting with a difference cover.

``repeats`` cuts the texts down to the segments that can hold a repeated window and deals them
out by anchor; equal windows always meet in one task. There the suffixes are sorted by the
difference-cover method: triples at the positions 1 and 2 modulo 3 are sorted and named, the
string of names is sorted by recursion, the remaining suffixes are sorted by (first byte, rank of
the next suffix) and merged in, and adjacent suffixes are compared on their first ``size`` bytes.
Segments that share little more than their anchor are left out of the sort (``may_repeat``).

Defined results: a null text is empty; a text shorter than the window keeps all its bytes; equal
texts (also rows that repeat id and text) are repeats of each other; an empty table gives an
empty result; other columns are not read. Removal may cut a character: the kept bytes are binary.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import repeats

SIZE = 400
GRAM = 24
PLACES = 8  # runs around an anchor that are compared before a sort


def _narrow(key: np.ndarray, top: int) -> np.ndarray:
    """Keys below ``top`` in the narrowest type that sorts fast."""
    return key.astype(np.uint32) if top <= 1 << 32 else key


def suffix_array(t: np.ndarray, enough: int | None = None) -> np.ndarray:
    """Order of the suffixes of ``t`` (non-negative integers).

    ``enough``: suffixes that agree in so many elements may stand in any order among themselves (the
    recursion ends once names are that long). None: the exact order.
    """
    n = len(t)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: t[i:].tolist()), np.int64)
    x = np.zeros(n + 3, np.uint64)
    x[:n] = t
    x[:n] += np.uint64(1)
    # sampled positions, one more if the first class would end the text with no empty triple after it
    p1 = np.arange(1, n + (n % 3 == 1), 3)
    p2 = np.arange(2, n, 3)
    sample = np.concatenate([p1, p2])
    top = int(x.max()) + 1
    k = np.uint64(top)
    if top ** 3 < 1 << 64:
        triple = _narrow((x[sample] * k + x[sample + 1]) * k + x[sample + 2], top ** 3)
        order = np.argsort(triple)
        new = np.concatenate([[True], triple[order][1:] != triple[order][:-1]])
    else:
        a, b, c = x[sample], x[sample + 1], x[sample + 2]
        order = np.lexsort((c, b, a))
        a, b, c = a[order], b[order], c[order]
        new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (c[1:] != c[:-1])])
    if not new.all() and (enough is None or enough > 3):
        names = np.empty(len(sample), np.int64)
        names[order] = np.cumsum(new) - 1
        order = suffix_array(names, None if enough is None else -(-enough // 3))
    rank = np.zeros(n + 3, np.uint64)
    rank[sample[order]] = np.arange(1, len(sample) + 1, dtype=np.uint64)
    sorted12 = sample[order]
    sorted12 = sorted12[sorted12 < n]
    p0 = np.arange(0, n, 3)
    wide = len(sample) + 1
    r = np.uint64(wide)
    sorted0 = p0[np.argsort(_narrow(x[p0] * r + rank[p0 + 1], top * wide))]
    # merge: how many sampled suffixes come before each remaining one
    s1, s2 = sorted12[sorted12 % 3 == 1], sorted12[sorted12 % 3 == 2]
    before = np.searchsorted(x[s1] * r + rank[s1 + 1], x[sorted0] * r + rank[sorted0 + 1])
    two, two0 = x[s2] * k + x[s2 + 1], x[sorted0] * k + x[sorted0 + 1]
    if top * top * wide >= 1 << 64:
        pairs = np.unique(np.concatenate([two, two0]), return_inverse=True)[1].astype(np.uint64)
        two, two0 = pairs[:len(s2)], pairs[len(s2):]
    before = before + np.searchsorted(two * r + rank[s2 + 2], two0 * r + rank[sorted0 + 2])
    out = np.empty(n, np.int64)
    # where long agreeing suffixes stand in any order, their counts may step back
    at0 = np.maximum.accumulate(before) + np.arange(len(sorted0))
    free = np.ones(n, bool)
    free[at0] = False
    out[at0] = sorted0
    out[free] = sorted12
    return out


def repeated_starts(pieces: list[bytes], size: int = SIZE) -> list[np.ndarray]:
    """For each piece the positions whose ``size`` bytes also start at another place in the pieces."""
    lengths = np.array([len(p) for p in pieces])
    offset = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
    text = np.zeros(int((lengths + 1).sum()), np.int64)
    flat = bytearray(len(text) + 8)
    may = np.zeros(len(text), bool)
    for o, p in zip(offset.tolist(), pieces):
        text[o:o + len(p)] = np.frombuffer(p, np.uint8)
        text[o:o + len(p)] += 1  # zero ends a piece
        flat[o:o + len(p)] = p
        may[o:o + max(0, len(p) - size + 1)] = True
    order = suffix_array(text, size + 4)
    order = order[may[order]]
    flat = bytes(flat)
    words = np.empty(len(text), np.uint64)  # eight bytes from every position
    for s in range(8):
        w = np.frombuffer(flat, "<u8", (len(flat) - s) // 8, s)
        words[s::8] = w[:len(words[s::8])]
    a, b = order[:-1], order[1:]
    for step in [*range(0, size - 7, 8), *([size - 8] if size % 8 else [])]:
        same = words[a + step] == words[b + step]
        a, b = a[same], b[same]
    hit = np.zeros(len(text), bool)
    hit[a] = hit[b] = True
    return [np.flatnonzero(hit[o:o + n]) for o, n in zip(offset.tolist(), lengths.tolist())]


def may_repeat(pieces: list[bytes], size: int = SIZE, gram: int = GRAM) -> np.ndarray:
    """For each segment whether a window of it can also be in another one of the ``pieces``.

    Equal windows have their anchor at the same place, so two segments with a common window agree around
    their anchors. A window that begins ``at - b`` to ``at - b - step + 1`` covers the run of ``size - step + 1``
    bytes from ``at - b``; a segment none of whose runs (one for each multiple ``b`` of ``step``) is in another
    segment has no window in common. Equal hashes of different runs only keep a segment that could go.
    """
    lengths = np.array([len(p) for p in pieces], np.int64)
    end = np.cumsum(lengths)
    begin = end - lengths
    codes = _codes(b"".join(pieces), None, None)
    # a segment's anchor is its leftmost gram of smallest hash: each gram is in one of its windows
    low = np.uint64((1 << 32) - 1)
    h = (repeats.mixed(repeats.poly(codes, gram)) & ~low) | np.arange(len(codes) - gram + 1, dtype=np.uint64)
    cuts = np.column_stack([begin, end - gram + 1]).ravel()[:-1]
    at = (np.minimum.reduceat(h, cuts)[::2] & low).astype(np.int64)
    step = -(-(size - gram + 1) // PLACES)
    width = size - step + 1
    run = repeats.poly(codes, width)
    may = np.zeros(len(pieces), bool)
    for b in range(0, size - gram + 1, step):
        held = np.flatnonzero((at - b >= begin) & (at - b + width <= end))
        _, kind, times = np.unique(run[at[held] - b], return_inverse=True, return_counts=True)
        may[held] |= times[kind] > 1
    return may


def repeated_among(pieces: list[bytes], size: int = SIZE, gram: int = GRAM) -> list[np.ndarray]:
    """``repeated_starts`` of whole anchor groups of different segments, sorting only those that can repeat."""
    may = may_repeat(pieces, size, gram)
    found = iter(repeated_starts([p for p, m in zip(pieces, may) if m], size) if may.any() else ())
    return [next(found) if m else np.empty(0, np.int64) for m in may]


def _split(text: str):
    data = text.encode("utf-8", "replace")
    at = np.arange(len(data) + 1)
    return data, at[:-1], at[1:]


def _codes(data, begin, end):
    return np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)


def dedup(df: DataFrame, id_col: str = "doc_id", text: str = "text", size: int = SIZE) -> DataFrame:
    """``(id, n_bytes, spans, kept)`` per row: the removed byte ranges and the remaining bytes."""
    if size < 8:
        raise ValueError("size must be 8 or more")
    units = repeats.Units(size, min(GRAM, max(1, size // 2)), _split, _codes)
    docs = repeats.keyed(df, id_col, text)
    spans = repeats.repeated_spans(docs, units, lambda pieces: repeated_among(pieces, size, units.gram))

    def run(batches):
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for b in batches:
            n, out, kept = [], [], []
            for v, f in zip(b.column(1), b.column(2)):
                data = v.as_py().encode("utf-8", "replace")
                got, at, left = repeats.merged_ranges(f.as_py()), 0, []
                for x, y in got:
                    left.append(data[at:x])
                    at = y
                left.append(data[at:])
                n.append(len(data))
                out.append([{"start": x, "end": y} for x, y in got])
                kept.append(b"".join(left))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(out, kind), pa.array(kept, pa.binary())],
                                             names=["id", "n_bytes", "spans", "kept"])

    kind = docs.schema["id"].dataType.simpleString()
    return repeats.with_found(docs, spans).mapInArrow(
        run, f"id {kind}, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")
