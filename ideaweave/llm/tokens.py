"""Token ids in files of fixed-width bit packing.

Every id takes the fewest bits that hold the vocabulary. Ids are packed in blocks of ``BLOCK`` ids;
64 ids of ``b`` bits fill ``b`` 64-bit words, so packing and unpacking are a loop over 64 columns of
numpy arrays. A file holds, after its header, the first id and the id column value of every document
and the byte offset of every block, so any range of ids is read by unpacking its blocks alone.

``write`` range-sorts the documents by id, encodes them and writes the files of a partition under
names that a repeated attempt writes again with the same content; ``offsets`` gives the ids before each file as two-level prefix sums; ``read`` unpacks files
through Spark, ``Shard`` reads one at random.

Defined results: a null text is empty (its end id alone); null ids come first, equal ids in the order
of a hash of their texts, equal rows as rows of their own; an empty table writes no file; long
texts are encoded in pieces cut at white space; other columns are not read.
"""

from __future__ import annotations

import itertools
import json
import os
import re
import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BLOCK = 4096  # ids in a block, a multiple of 64
FILE_IDS = 8 << 20  # a file is closed at the first document after so many ids
PIECE_CHARS = 4 << 20  # longer texts are encoded in pieces
LOT_CHARS = 8 << 20  # texts encoded together
CACHE_WORDS = 500_000
GATHER_IDS = 1 << 18  # ids whose positions are held at a time
MAGIC = b"IWTOKENS"
_HEAD = struct.Struct("<8sIIQQ")  # magic, bits, block, documents, ids
_SPACE = re.compile(r"[\x20\x09-\x0D]")
_TAIL = ".,;:!?"


def bits_for(vocab_size: int) -> int:
    """Bits of the largest id of a vocabulary."""
    return max(1, (vocab_size - 1).bit_length())


def vocabulary_size(tokenizer: str) -> int:
    """Ids of a ``tokenizers`` file, added ones included."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer).get_vocab_size(with_added_tokens=True)


def pack(ids: np.ndarray, bits: int) -> bytes:
    """``ids`` at ``bits`` bits each, little-endian 64-bit words, zero ids up to a multiple of 64."""
    n = -(-len(ids) // 64)
    rows = np.zeros((n, 64), np.uint64)
    rows.reshape(-1)[:len(ids)] = ids
    out = np.zeros((n, bits), np.uint64)
    for j in range(64):
        word, shift = divmod(j * bits, 64)
        out[:, word] |= rows[:, j] << np.uint64(shift)
        if shift + bits > 64:
            out[:, word + 1] |= rows[:, j] >> np.uint64(64 - shift)
    return out.astype("<u8").tobytes()


def unpack(data, bits: int, n: int) -> np.ndarray:
    """The first ``n`` ids of packed ``data``."""
    words = np.frombuffer(data, "<u8").reshape(-1, bits)
    out = np.empty((len(words), 64), np.uint64)
    mask = np.uint64((1 << bits) - 1)
    for j in range(64):
        word, shift = divmod(j * bits, 64)
        x = words[:, word] >> np.uint64(shift)
        if shift + bits > 64:
            x = x | words[:, word + 1] << np.uint64(64 - shift)
        out[:, j] = x & mask
    return out.reshape(-1)[:n].astype(np.uint32)


def shard_bytes(doc_ids, lengths, ids: np.ndarray, bits: int, block: int = BLOCK) -> bytes:
    """One file: header, first id and id value of each document, block offsets, packed blocks."""
    blocks = [pack(ids[a:a + block], bits) for a in range(0, len(ids), block)]
    first = np.concatenate([[0], np.cumsum(np.asarray(lengths, np.int64))])
    known = np.array([d is not None for d in doc_ids], np.uint8)
    values = np.array([0 if d is None else d for d in doc_ids], "<i8")
    at = np.concatenate([[0], np.cumsum([len(b) for b in blocks])])
    return b"".join([_HEAD.pack(MAGIC, bits, block, len(known), len(ids)), first.astype("<u8").tobytes(), values.tobytes(),
                     at.astype("<u8").tobytes(), known.tobytes(), *blocks])


class Shard:
    """Random access to one file's bytes (any buffer, such as a memory map)."""

    def __init__(self, data):
        magic, self.bits, self.block, n_docs, self.n_ids = _HEAD.unpack_from(data, 0)
        if magic != MAGIC:
            raise ValueError("not a token file")
        p, n_blocks = _HEAD.size, -(-self.n_ids // self.block)
        self.first = np.frombuffer(data, "<u8", n_docs + 1, p).astype(np.int64)
        values = np.frombuffer(data, "<i8", n_docs, p := p + 8 * (n_docs + 1)).tolist()
        self.at = np.frombuffer(data, "<u8", n_blocks + 1, p := p + 8 * n_docs).astype(np.int64)
        known = np.frombuffer(data, np.uint8, n_docs, p := p + 8 * (n_blocks + 1))
        self.doc_ids = [v if k else None for v, k in zip(values, known.tolist())]
        self.payload = memoryview(data)[p + n_docs:]

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the file; only their blocks are unpacked."""
        if start >= stop:
            return np.empty(0, np.uint32)
        a, z = start // self.block, (stop - 1) // self.block
        return unpack(self.payload[self.at[a]:self.at[z + 1]], self.bits, stop - a * self.block)[start - a * self.block:]

    def document(self, i: int) -> np.ndarray:
        return self.ids(int(self.first[i]), int(self.first[i + 1]))


# -- encoding ----------------------------------------------------------------------------------


class Encoder:
    """Texts to ids by a ``tokenizers`` file.

    ``by_word``: each distinct word between white space is encoded once, and full stops and the like
    behind an ASCII letter are encoded apart. This gives the ids of the whole text for tokenizers that
    drop white space, lower-case, and part letters from punctuation; use ``by_word=False`` (whole
    texts) for all others. The first ``CACHE_WORDS`` words a worker meets are kept with their ids.
    """

    def __init__(self, path: str, by_word: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one thread a task
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.by_word = by_word
        suffix = json.loads(self.tok.to_str())["model"].get("end_of_word_suffix")
        self.ends = None
        if suffix:  # which ids end a word
            self.ends = np.zeros(self.tok.get_vocab_size(with_added_tokens=True), bool)
            self.ends[[i for t, i in self.tok.get_vocab().items() if t.endswith(suffix)]] = True
        self.known = pa.array([], pa.large_string())
        self.known_n, self.known_ids = np.empty(0, np.int64), np.empty(0, np.uint32)

    def apart(self, words: list[str]):
        """Ids and numbers of ids of words encoded one by one."""
        got = [e.ids for e in self.tok.encode_batch_fast(words, add_special_tokens=False)]
        return np.fromiter(itertools.chain.from_iterable(got), np.uint32), np.fromiter(map(len, got), np.int64, len(got))

    def letters(self, words: list[str]):
        """The same for words of letters: encoded as one text, cut at the ids that end a word."""
        if self.ends is None:
            return self.apart(words)
        ids = np.array(self.tok.encode(" ".join(words), add_special_tokens=False).ids, np.uint32)
        end = np.flatnonzero(self.ends[ids]) + 1
        if len(end) != len(words):  # a word that the tokenizer takes for more than one
            return self.apart(words)
        return ids, np.diff(end, prepend=0)

    def fresh(self, words: pa.Array):
        """``(ids, numbers of ids)`` of distinct words."""
        plain = pc.utf8_is_alpha(words).to_numpy(zero_copy_only=False)
        order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])
        parts, turned = [], words.take(pa.array(order)).to_pylist()
        cut = int(plain.sum())
        for a in range(0, cut, 2000):
            parts.append(self.letters(turned[a:min(a + 2000, cut)]))
        for a in range(cut, len(turned), 2000):
            parts.append(self.apart(turned[a:a + 2000]))
        ids, n = (np.concatenate(x) for x in zip(*parts)) if parts else (np.empty(0, np.uint32), np.empty(0, np.int64))
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        return _gather(ids, n, back), n[back]

    def words(self, words: pa.Array):
        """``(ids, numbers of ids)`` of words, through the cache."""
        at = pc.index_in(words, value_set=self.known)
        new = words.filter(at.is_null())
        ids, n = self.fresh(new)
        at = at.to_numpy(zero_copy_only=False) if at.null_count == 0 else \
            pc.fill_null(at, -1).to_numpy()
        at = at.astype(np.int64)
        at[at < 0] = len(self.known) + np.arange(len(new))
        pool, size = np.concatenate([self.known_ids, ids]), np.concatenate([self.known_n, n])
        if len(self.known) < CACHE_WORDS:
            keep = min(len(new), CACHE_WORDS - len(self.known))
            self.known = pa.concat_arrays([self.known, new.slice(0, keep)])
            self.known_n = size[:len(self.known)]
            self.known_ids = pool[:int(self.known_n.sum())]
        return _gather(pool, size, at), size[at]

    def flat(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, number of ids of each text)``."""
        if not self.by_word:
            return self.apart(texts.to_pylist())
        split = pc.ascii_split_whitespace(texts.cast(pa.large_string()))
        first = split.offsets.to_numpy().astype(np.int64)
        seen = pc.dictionary_encode(split.values[first[0]:first[-1]])
        whole = seen.dictionary
        core = pc.ascii_rtrim(whole, characters=_TAIL)
        cut = pc.ascii_is_alpha(pc.utf8_slice_codeunits(core, -1))
        core = pc.if_else(cut, core, whole)
        low = pc.if_else(pc.ascii_is_alpha(core), pc.ascii_lower(core), core)
        behind = np.flatnonzero(pc.binary_length(core).to_numpy() < pc.binary_length(whole).to_numpy())
        tails = [w[len(c):] for w, c in zip(whole.take(pa.array(behind)).to_pylist(), core.take(pa.array(behind)).to_pylist())]
        pieces = pc.dictionary_encode(pa.concat_arrays([low, pa.array(tails, pa.large_string())]))
        ids, n = self.words(pieces.dictionary)
        piece = pieces.indices.to_numpy()
        # a word's ids: those of its core, then those of its tail
        tail_at = np.cumsum(np.bincount(behind, minlength=len(whole)))
        sequence = np.insert(piece[:len(whole)], behind + 1, piece[len(whole):])
        begin = np.arange(len(whole)) + np.concatenate([[0], tail_at[:-1]])
        part = np.concatenate([[0], np.cumsum(n[sequence])])
        stop = np.append(begin[1:], len(sequence))
        pool, size = _gather(ids, n, sequence), part[stop] - part[begin]
        word = seen.indices.to_numpy()
        at = np.concatenate([[0], np.cumsum(size[word])])
        return _gather(pool, size, word), np.diff(at[first - first[0]])

    def long(self, text: str) -> np.ndarray:
        """Ids of a text of any length, in pieces cut at white space."""
        if not self.by_word:
            return self.flat(pa.array([text]))[0]
        out, a = [], 0
        while a < len(text):
            m = _SPACE.search(text, a + PIECE_CHARS)
            z = m.end() if m else len(text)
            out.append(self.flat(pa.array([text[a:z]]))[0])
            a = z
        return np.concatenate(out)


def _gather(pool: np.ndarray, n: np.ndarray, pick: np.ndarray) -> np.ndarray:
    """The runs ``pick`` of ``pool``, which holds runs of ``n`` ids; positions are made for ``GATHER_IDS`` ids at a time."""
    begin, size = np.cumsum(n) - n, n[pick]
    stop = np.cumsum(size)
    out, a = np.empty(int(stop[-1]) if len(stop) else 0, pool.dtype), 0
    while a < len(pick):
        done = int(stop[a] - size[a])
        z = max(a + 1, int(np.searchsorted(stop, done + GATHER_IDS, "right")))
        at = np.repeat(begin[pick[a:z]] - (stop[a:z] - size[a:z]), size[a:z])
        at += np.arange(done, int(stop[z - 1]))
        np.take(pool, at, out=out[done:int(stop[z - 1])], mode="clip")
        a = z
    return out


_ENCODERS: dict = {}


def _encoder(path: str, by_word: bool) -> Encoder:
    """One encoder per worker process, so its cache serves all tasks of the worker."""
    if (path, by_word) not in _ENCODERS:
        _ENCODERS[path, by_word] = Encoder(path, by_word)
    return _ENCODERS[path, by_word]


def _rows(df: DataFrame, id_col: str, text: str) -> DataFrame:
    return df.select(df[id_col].cast("long").alias("id"), F.coalesce(df[text], F.lit("")).alias("text"))


def _encoded(batches, tokenizer: str, end_id: int | None, by_word: bool):
    """``(ids column, numbers of ids, ids)`` per lot of texts of bounded size."""
    enc = _encoder(tokenizer, by_word)
    for b in batches:
        doc_ids, texts = b.column(0), b.column(1).cast(pa.large_string())
        size = pc.utf8_length(texts).to_numpy(zero_copy_only=False)
        a = 0
        while a < len(size):
            if size[a] > PIECE_CHARS:
                z, flat = a + 1, enc.long(texts[a].as_py())
                n = np.array([len(flat)])
            else:
                z, held = a, 0
                while z < len(size) and size[z] <= PIECE_CHARS and (z == a or held + size[z] <= LOT_CHARS):
                    held += size[z]
                    z += 1
                flat, n = enc.flat(texts.slice(a, z - a))
            if end_id is not None:
                flat, n = np.insert(flat, np.cumsum(n), np.uint32(end_id)), n + 1
            pa.default_memory_pool().release_unused()  # a worker that waits keeps none of a lot's memory
            yield doc_ids.slice(a, z - a), n, flat
            a = z


def _id_lists(n: np.ndarray, flat: np.ndarray) -> pa.Array:
    """Ids as one binary value of little-endian unsigned 32-bit integers per document."""
    at = np.concatenate([[0], np.cumsum(n) * 4]).astype(np.int64)
    data = pa.py_buffer(np.ascontiguousarray(flat, "<u4"))
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(at), data]).cast(pa.binary())


def encode(df: DataFrame, tokenizer: str, end_id: int | None, id_col: str = "doc_id", text: str = "text",
           by_word: bool = True) -> DataFrame:
    """``(id, n, ids)`` per row: the number of ids and the ids (``end_id`` last) as unsigned 32-bit integers."""
    def run(batches):
        for doc_ids, n, flat in _encoded(batches, tokenizer, end_id, by_word):
            yield pa.RecordBatch.from_arrays([doc_ids, pa.array(n, pa.int64()), _id_lists(n, flat)], names=["id", "n", "ids"])

    return _rows(df, id_col, text).mapInArrow(run, "id long, n long, ids binary")


# -- files -------------------------------------------------------------------------------------


def write(df: DataFrame, path: str, tokenizer: str, end_id: int | None, id_col: str = "doc_id", text: str = "text",
          by_word: bool = True, parts: int | None = None, file_ids: int = FILE_IDS) -> DataFrame:
    """Encode the texts and write their ids below ``path`` (a shared folder) in ascending id order.

    The texts are range-sorted and encoded where they are written, so ids are never shuffled.
    ``(part, seq, file, n_docs, n_ids)`` per file. Lazy.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # rows of one id are dealt out too: by a hash of the text, and equal rows by where they were read
    keyed = _rows(df, id_col, text).withColumns({"h": F.xxhash64("text"), "salt": F.monotonically_increasing_id()})
    order = [F.col("id").asc_nulls_first(), F.col("h").asc(), F.col("salt").asc()]
    rows = keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("id", "text")
    bits = bits_for(max(vocabulary_size(tokenizer), (end_id or 0) + 1))

    def run(batches):
        store, base = pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path.removeprefix("file:"))
        store.create_dir(base, recursive=True)
        part, seq, docs, lengths, ids, held = TaskContext.get().partitionId(), 0, [], [], [], 0

        def close():
            nonlocal seq, docs, lengths, ids, held
            name = f"part-{part:06d}-{seq:05d}.ids"
            with store.open_output_stream(f"{base}/{name}", compression=None) as f:
                f.write(shard_bytes(docs, np.concatenate(lengths), np.concatenate(ids), bits))
            got = pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int64()), "seq": pa.array([seq], pa.int64()), "file": [name],
                                              "n_docs": pa.array([len(docs)], pa.int64()), "n_ids": pa.array([held], pa.int64())})
            seq, docs, lengths, ids, held = seq + 1, [], [], [], 0
            return got

        for doc_ids, n, flat in _encoded(batches, tokenizer, end_id, by_word):
            at, a = np.concatenate([[0], np.cumsum(n)]), 0
            while a < len(n):
                z = min(len(n), int(np.searchsorted(at, at[a] + file_ids - held)))
                docs += doc_ids.slice(a, z - a).to_pylist()
                lengths.append(n[a:z])
                ids.append(flat[at[a]:at[z]].astype(np.uint32))
                held += int(at[z] - at[a])
                a = z
                if held >= file_ids:
                    yield close()
        if docs:
            yield close()

    return rows.mapInArrow(run, "part long, seq long, file string, n_docs long, n_ids long")


def offsets(manifest: DataFrame) -> DataFrame:
    """``(file, base)``: the ids in all files before. Sums per 1,024 partitions first, so no task sees every file."""
    m = manifest.withColumn("lot", F.floor(F.col("part") / 1024))
    lots = m.groupBy("lot").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("lot").rowsBetween(Window.unboundedPreceding, -1)
    lots = lots.select(F.col("lot").alias("lot2"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("lot_base"))
    inside = Window.partitionBy("lot").orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    m = m.withColumn("in_lot", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)))
    return m.join(lots, F.col("lot") == F.col("lot2")).select("file", (F.col("lot_base") + F.col("in_lot")).alias("base"))


def read(spark: SparkSession, path: str) -> DataFrame:
    """``(file, id, first, n, ids)`` per document of every file below ``path``; ``first`` counts inside the file."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.ids").load(path)
             .select(F.element_at(F.split("path", "/"), -1).alias("file"), "content"))

    def run(batches):
        for b in batches:
            for name, content in zip(b.column(0).to_pylist(), b.column(1)):
                s = Shard(content.as_buffer())
                n_docs, a = len(s.doc_ids), 0
                while a < n_docs:  # lots of documents of bounded size
                    z = max(a + 1, int(np.searchsorted(s.first, s.first[a] + (1 << 20), "right")) - 1)
                    flat = s.ids(int(s.first[a]), int(s.first[z]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * (z - a)), pa.array(s.doc_ids[a:z], pa.int64()), pa.array(s.first[a:z]),
                         pa.array(np.diff(s.first[a:z + 1])), _id_lists(np.diff(s.first[a:z + 1]), flat)], names=["file", "id", "first", "n", "ids"])
                    a = z

    return files.mapInArrow(run, "file string, id long, first long, n long, ids binary")
