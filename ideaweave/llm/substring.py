"""Repeated passages by fixed-block anchors, on words.

``repeats`` cuts the texts down to the segments that can hold a repeated window and deals them
out by anchor; equal windows always meet in one task. There non-overlapping reference blocks of
``block`` words are indexed (every window of ``2 * block - 1`` words holds one in full), every
rolling window of ``block`` words probes the index, and the windows around each hit are extended:
a hit counts where the whole ``size``-word window equals another one, and neighbouring ones join
to maximal exact repeats.

Defined results: a null text has no words; a text shorter than the window keeps all its words;
equal texts (also rows that repeat id and text) are repeats of each other; an empty table gives
an empty result; other columns are not read. Words are compared by their 64-bit hash.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from . import repeats
from .common import WORD_BYTES

SIZE = 35
GRAM = 4
_WORD = re.compile(WORD_BYTES)


def word_codes(words: list[bytes]) -> np.ndarray:
    h = xxhash.xxh3_64_intdigest
    return np.fromiter(map(h, words), np.uint64, len(words))


def repeated_starts(pieces: list[bytes], size: int = SIZE) -> list[np.ndarray]:
    """For each piece the window starts whose ``size`` words also start at another place in the pieces."""
    block = (size + 1) // 2
    codes = [word_codes(p.split(b" ")) for p in pieces]
    lengths = np.array([len(c) for c in codes])
    offset = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    all_codes = np.concatenate(codes)
    n = len(all_codes)
    place = np.arange(n) - np.repeat(offset, lengths)  # position inside the piece
    left = np.repeat(lengths, lengths) - place  # words from here to the end of the piece
    if n < size:
        return [np.zeros(0, np.int64) for _ in pieces]
    rolling = repeats.mixed(repeats.poly(all_codes, block))
    inside = left[:len(rolling)] >= block
    # index: the blocks that begin at multiples of the block length
    index = np.unique(rolling[inside & (place[:len(rolling)] % block == 0)])
    if not len(index):
        return [np.zeros(0, np.int64) for _ in pieces]
    # probe: every rolling window
    at = np.minimum(np.searchsorted(index, rolling), len(index) - 1)
    found = inside & (index[at] == rolling)
    times = np.bincount(at[found], minlength=len(index))
    hit = found & (times[at] > 1)
    # extend: windows that hold a hit, compared in full
    reach = size - block + 1
    total = np.concatenate([[0], np.cumsum(hit)])
    starts = np.flatnonzero(left >= size)
    ends = np.minimum(starts + reach, len(hit))
    starts = starts[total[ends] > total[starts]]
    full = np.zeros(n, bool)
    if len(starts):
        whole = repeats.mixed(repeats.poly(all_codes, size))[starts]
        order = np.argsort(whole, kind="stable")
        whole, s = whole[order], starts[order]
        same = whole[1:] == whole[:-1]
        a, b = s[:-1][same], s[1:][same]
        for step in range(size):  # exact comparison of neighbours
            eq = all_codes[a + step] == all_codes[b + step]
            a, b = a[eq], b[eq]
        full[a] = full[b] = True
    return [np.flatnonzero(full[o:o + m]) for o, m in zip(offset.tolist(), lengths.tolist())]


def _split(text: str):
    words = _WORD.findall(text.encode("utf-8", "replace"))
    end = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    return b" ".join(words), np.concatenate([[0], end[:-1] + 1]) if words else end, end


def _codes(data, begin, end):
    return word_codes(data.split(b" "))


def dedup(df: DataFrame, id_col: str = "doc_id", text: str = "text", size: int = SIZE) -> DataFrame:
    """``(id, n_words, spans, kept)`` per row: the removed word ranges and the kept words, one space between."""
    units = repeats.Units(size, min(GRAM, max(1, size // 2)), _split, _codes)
    docs = repeats.keyed(df, id_col, text)
    spans = repeats.repeated_spans(docs, units, lambda pieces: repeated_starts(pieces, size))

    def run(batches):
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for b in batches:
            n, out, kept = [], [], []
            for v, f in zip(b.column(1), b.column(2)):
                words = _WORD.findall(v.as_py().encode("utf-8", "replace"))
                got, at, left = repeats.merged_ranges(f.as_py()), 0, []
                for x, y in got:
                    left += words[at:x]
                    at = y
                left += words[at:]
                n.append(len(words))
                out.append([{"start": x, "end": y} for x, y in got])
                kept.append(b" ".join(left).decode("utf-8"))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(out, kind), pa.array(kept, pa.string())],
                                             names=["id", "n_words", "spans", "kept"])

    kind = docs.schema["id"].dataType.simpleString()
    return repeats.with_found(docs, spans).mapInArrow(
        run, f"id {kind}, n_words long, spans array<struct<start:long,end:long>>, kept string")
