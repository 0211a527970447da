"""WARC writing with revisit records, and a salvage reader.

Writing: one gzip member per record, so every record can be found again on its own. Of records
with equal payloads of at least ``min_revisit`` bytes the one with the largest id is stored, the
others refer to it. A task writes the files of its partition under names that a repeated attempt
writes again with the same records (rows are sorted inside the partition), so nothing is doubled.

Reading: a member must inflate with a right checksum, its version line, headers, length and block
digest must agree. After a failed check the reader searches for the next gzip member or version
line that passes them, goes on from there, and logs the bytes between as a quarantined gap. Inside a
member the search goes over its content, and the gap's reason names the offsets inside. Of a broken or
cut member the content up to the damage counts; if it is damaged, only records with a right block digest.

Defined results: a null payload is empty; a null id is written as ``none`` and read as null, and is
smaller than any id; equal ids with equal payloads are equal records; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MIN_REVISIT = 1000
FILE_BYTES = 16 << 20  # a file is read as one row
DATE = "1970-01-01T00:00:00Z"
_ID = re.compile(r"<urn:x-page:(-?\w+)>")
_VERSION = re.compile(rb"WARC/1\.[01]\r\n")
_NEXT = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")


def plan_records(pages: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html",
                 min_revisit: int = MIN_REVISIT) -> DataFrame:
    """``(page_id, url, payload, payload_bytes, payload_digest, refers_to, revisit)``; payload null for revisits."""
    body = F.coalesce(pages[html].cast("binary"), F.lit(b""))
    rows = pages.select(pages[id_col].alias("page_id"), pages[url].cast("string").alias("url"), body.alias("payload"))
    rows = rows.withColumns({"payload_bytes": F.octet_length("payload").cast("long"),
                             "payload_digest": F.sha1("payload"), "same": F.sha2("payload", 256)})
    first = (rows.where(F.col("payload_bytes") >= min_revisit).groupBy("same")
             .agg(F.max("page_id").alias("first"), F.count("*").alias("n")).where("n > 1")
             .select(F.col("same").alias("same2"), "first", F.lit(True).alias("shared")))
    j = rows.join(first, F.col("same") == F.col("same2"), "left")
    revisit = F.coalesce(F.col("shared"), F.lit(False)) & ~F.col("page_id").eqNullSafe(F.col("first"))
    return j.select("page_id", "url", F.when(~revisit, F.col("payload")).alias("payload"), "payload_bytes",
                    "payload_digest", F.when(revisit, F.col("first")).alias("refers_to"), revisit.alias("revisit"))


def record_bytes(page_id, url, payload, n_bytes: int, digest: str, refers_to, revisit: bool) -> bytes:
    """One WARC/1.1 record, uncompressed."""
    name = lambda x: f"<urn:x-page:{'none' if x is None else x}>"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {name(page_id)}",
            f"WARC-Date: {DATE}", "Content-Type: application/http; msgtype=response",
            "WARC-Block-Digest: sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode(),
            "WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest)).decode(),
            f"X-Payload-Length: {n_bytes}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\r\n]+", " ", url))
    if revisit:
        head += [f"WARC-Refers-To: {name(refers_to)}",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode("utf-8", "replace") + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """``data`` as one gzip member (no time stamp: equal records give equal bytes)."""
    c = zlib.compressobj(6, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def write(records: DataFrame, path: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write planned records below ``path`` (a shared folder); ``(file, n_records, n_bytes)`` per file. Lazy."""
    rows = records.sortWithinPartitions("page_id", "payload_digest", "revisit", "url")

    def run(batches):
        store, base = pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path.removeprefix("file:"))
        store.create_dir(base, recursive=True)
        part, k, buffer, n = TaskContext.get().partitionId(), 0, [], 0

        def close():
            nonlocal k, buffer, n
            name, size = f"part-{part:05d}-{k:05d}.warc.gz", sum(map(len, buffer))
            with store.open_output_stream(f"{base}/{name}", compression=None) as f:
                f.write(b"".join(buffer))
            got = pa.RecordBatch.from_pydict({"file": [name], "n_records": pa.array([n], pa.int64()),
                                              "n_bytes": pa.array([size], pa.int64())})
            k, buffer, n = k + 1, [], 0
            return got

        held = 0
        for b in batches:
            for row in zip(*[c.to_pylist() for c in b.columns]):
                buffer.append(member(record_bytes(*row)))
                held += len(buffer[-1])
                n += 1
                if held >= file_bytes:
                    yield close()
                    held = 0
        if buffer:
            yield close()

    return rows.mapInArrow(run, "file string, n_records long, n_bytes long")


def parse_record(data, at: int):
    """(headers, block, end) of the record that begins at ``at``; ValueError with the failed check."""
    v = _VERSION.match(data, at)
    if not v:
        raise ValueError("version line")
    stop = data.find(b"\r\n\r\n", v.end() - 2)
    if stop < 0:
        raise ValueError("headers")
    headers = {}
    for line in data[v.end():stop].decode("utf-8", "replace").split("\r\n"):
        key, colon, value = line.partition(":")
        if not colon:
            raise ValueError("headers")
        headers[key.strip().lower()] = value.strip()
    size = headers.get("content-length", "")
    if not size.isdigit():
        raise ValueError("length")
    begin, end = stop + 4, stop + 4 + int(size)
    if data[end:end + 4] != b"\r\n\r\n":
        raise ValueError("length")
    block = data[begin:end]
    kind, _, want = headers.get("warc-block-digest", "").partition(":")
    if kind.lower() == "sha1" and base64.b32encode(hashlib.sha1(block).digest()).decode() != want.upper():
        raise ValueError("block digest")
    return headers, block, end + 4


def inflate(data: bytes, at: int):
    """(content, end, None) of the gzip member that begins at ``at``; (content so far, None, reason) if it is broken or cut."""
    d, view, out, p, step = zlib.decompressobj(31), memoryview(data), [], at, 65536
    while not d.eof and p < len(data):
        was = d.copy()
        try:
            out.append(d.decompress(view[p:p + step]))
            p += step
        except zlib.error:
            if step == 1:
                return b"".join(out), None, "gzip member"
            d, step = was, step // 16  # nearer to the damage
    if not d.eof:
        return b"".join(out), None, "gzip member cut"
    return b"".join(out), min(p, len(data)) - len(d.unused_data), None


def salvage_content(content: bytes, damaged: bool):
    """``salvage`` of a member's content: ``(start, end, headers, block, reason)``, headers null for gaps."""
    at, bad, why = 0, None, None
    while at < len(content):
        try:
            headers, block, end = parse_record(content, at)
            if damaged and not headers.get("warc-block-digest", "").lower().startswith("sha1:"):
                raise ValueError("no block digest")
        except ValueError as e:
            if bad is None:
                bad, why = at, str(e)
            nxt = _VERSION.search(content, at + 1)
            at = nxt.start() if nxt else len(content)
            continue
        if bad is not None:
            yield bad, at, None, None, why
            bad = None
        yield at, end, headers, block, None
        at = end
    if bad is not None:
        yield bad, len(content), None, None, why


def salvage(data: bytes):
    """Yields ``("record", start, end, headers, block, None)`` and ``("gap", start, end, None, None, reason)``.

    What comes from inside a member has the member's start and end; those of a broken member end at
    the next one that passes.
    """
    at, bad, why, kept = 0, None, None, []

    def inside(start, end, found):
        for p, q, headers, block, reason in found:
            if headers is None:
                yield "gap", start, end, None, None, f"{reason} (inside member, {p}-{q})"
            else:
                yield "record", start, end, headers, block, None

    while at < len(data):
        found, end, failed = [], None, None
        if data[at:at + 3] == b"\x1f\x8b\x08":
            content, end, failed = inflate(data, at)
            found = list(salvage_content(content, failed == "gzip member"))
            if found and all(x[2] is None for x in found):
                found, failed = [], failed or found[0][4]
            elif found and failed:
                failed = f"{failed} (inside member, from {len(content)})"
        else:
            try:
                headers, block, end = parse_record(data, at)
                found.append((at, end, headers, block, None))
            except ValueError as e:
                failed = str(e)
        if bad is not None and (found or not failed):
            yield from inside(bad, at, kept)
            yield "gap", bad, at, None, None, why
            bad, kept = None, []
        if not failed:
            yield from inside(at, end, found)
        elif bad is None:
            bad, why, kept = at, failed, found
        if failed and end is None:
            nxt = _NEXT.search(data, at + 1)
            end = nxt.start() if nxt else len(data)
        at = end
    if bad is not None:
        yield from inside(bad, len(data), kept)
        yield "gap", bad, len(data), None, None, why


SCHEMA = ("status string, file string, start long, end long, reason string, page_id long, record_type string, "
          "target_uri string, refers_to long, payload_length long, stored_digest string, payload binary")


def read(spark: SparkSession, path: str, glob: str = "*.warc*") -> DataFrame:
    """Records and quarantined gaps (column ``status``) of every archive below ``path``, read through Spark."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
             .load(path).select("path", "content"))

    def page(name: str | None):
        m = _ID.fullmatch(name or "")
        return int(m[1]) if m and m[1] != "none" else None

    def run(batches):
        types = [("status", pa.string()), ("file", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                 ("reason", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string()),
                 ("target_uri", pa.string()), ("refers_to", pa.int64()), ("payload_length", pa.int64()),
                 ("stored_digest", pa.string()), ("payload", pa.binary())]

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), types)],
                                              names=[n for n, _ in types])

        for b in batches:
            for name, content in zip(b.column(0), b.column(1)):
                rows, held, name = [], 0, name.as_py()
                for status, start, end, h, block, why in salvage(content.as_py()):
                    if status == "gap":
                        rows.append((status, name, start, end, why, *[None] * 7))
                    else:
                        kind = h.get("warc-type")
                        payload = block
                        if h.get("content-type", "").startswith("application/http"):
                            payload = block.partition(b"\r\n\r\n")[2]
                        dig = h.get("warc-payload-digest", "").partition(":")[2]
                        try:
                            dig = base64.b32decode(dig).hex() if dig else None
                        except ValueError:
                            dig = None
                        size = h.get("x-payload-length", "")
                        rows.append((status, name, start, end, None, page(h.get("warc-record-id")), kind,
                                     h.get("warc-target-uri"), page(h.get("warc-refers-to")),
                                     int(size) if size.isdigit() else None, dig,
                                     None if kind == "revisit" else payload))
                        held += len(block)
                    if held > 4 << 20:
                        yield batch(rows)
                        rows, held = [], 0
                if rows:
                    yield batch(rows)

    return files.mapInArrow(run, SCHEMA)


def records(found: DataFrame) -> DataFrame:
    return found.where("status = 'record'")


def gaps(found: DataFrame) -> DataFrame:
    """The log of quarantined bytes: file, start, end, failed check."""
    return found.where("status = 'gap'").select("file", "start", "end", "reason")
