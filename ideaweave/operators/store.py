"""Caches and incremental state as snapshot tables.

A table is a folder of versions ``<root>/<table>/v=<n>/`` (Parquet). A reader takes the
highest version that has ``_SUCCESS``; a writer always writes a new version, so a plan
never overwrites the files it reads, and a failed write leaves the previous version live.
Caches are joined in bulk (semi/anti joins), never probed row by row. Tables that grow are
append-only (``seq=<n>`` parts) and merged on read, so a run writes only what is new.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def hadoop_fs(spark: SparkSession, path: str):
    """(FileSystem, Path) for any Hadoop-supported URI (file:, hdfs:, s3a:, abfs:, ...)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


class SnapshotStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _versions(self, table: str) -> list[int]:
        fs, d = hadoop_fs(self.spark, f"{self.root}/{table}")
        if not fs.exists(d):
            return []
        out = []
        for st in fs.listStatus(d):
            name = st.getPath().getName()
            m = re.fullmatch(r"v=(\d+)", name)
            if m and fs.exists(st.getPath().suffix("/_SUCCESS")):
                out.append(int(m.group(1)))
        return sorted(out)

    def latest(self, table: str) -> int | None:
        v = self._versions(table)
        return v[-1] if v else None

    def read(self, table: str, schema: T.StructType | str | None = None) -> DataFrame | None:
        v = self.latest(table)
        if v is None:
            return self.spark.createDataFrame([], schema) if schema is not None else None
        return self.spark.read.parquet(f"{self.root}/{table}/v={v}")

    def write(self, table: str, df: DataFrame, partition_by: list | None = None) -> int:
        v = (self.latest(table) or 0) + 1
        w = df.write.mode("errorifexists")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(f"{self.root}/{table}/v={v}")
        return v

    def append(self, table: str, df: DataFrame, seq: int, partition_by: list | None = None) -> None:
        """Append-only table: each call writes one ``seq=<n>`` part; other parts are never rewritten.
        A repeated call (replay after a failure) replaces its own part."""
        w = df.write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(f"{self.root}/{table}/seq={int(seq)}")

    def _scan(self, table: str) -> tuple[list[int], int]:
        """(numbers of the committed parts, the number from which they count)."""
        fs, d = hadoop_fs(self.spark, f"{self.root}/{table}")
        parts, base = [], 0
        if not fs.exists(d):
            return parts, base
        for st in fs.listStatus(d):
            m = re.fullmatch(r"seq=(\d+)", st.getPath().getName())
            if m and fs.exists(st.getPath().suffix("/_SUCCESS")):
                parts.append(int(m[1]))
            b = re.fullmatch(r"_base=(\d+)", st.getPath().getName())
            base = max(base, int(b[1])) if b else base
        return sorted(parts), base

    def _parts(self, table: str) -> list[int]:
        parts, base = self._scan(table)
        return [n for n in parts if n >= base]

    def read_parts(self, table: str, before: int | None = None, upto: int | None = None) -> DataFrame | None:
        """Committed parts of an append-only table (those with ``_SUCCESS``), numbered below ``before`` if given."""
        parts = [n for n in self._parts(table) if (before is None or n < before) and (upto is None or n <= upto)]
        if not parts:
            return None
        return (self.spark.read.option("basePath", f"{self.root}/{table}")
                .parquet(*[f"{self.root}/{table}/seq={n}" for n in parts]))

    def read_part(self, table: str, seq: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{table}/seq={int(seq)}")

    def next_part(self, table: str) -> int:
        parts, base = self._scan(table)
        return max([*parts, base - 1, 0]) + 1

    def drop_parts(self, table: str, first: int | None = None) -> None:
        """Leaves the parts written so far out of later reads; the next part is ``first`` or the next free one."""
        n = max(first or 1, self.next_part(table))
        if n > 1:
            self._mark(table, n)

    def _mark(self, table: str, n: int) -> None:
        fs, d = hadoop_fs(self.spark, f"{self.root}/{table}/_base={n}")
        fs.mkdirs(d)

    def newest(self, rows: DataFrame, entries: DataFrame, key: str, hashed: bool = False) -> DataFrame:
        """Rows whose part is the latest that ``entries`` has for their key.

        Keys of a single part (most of them) need no lookup: only those written again are joined.
        ``hashed``: rows are dealt by the key already and are not sorted for the join.
        """
        last = entries.groupBy(key).agg(F.max("seq").alias("_last"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
        last = last.hint("shuffle_hash") if hashed else last
        return rows.join(last, key, "left").where(F.col("_last").isNull() | (F.col("seq") == F.col("_last"))).drop("_last")

    def merged(self, table: str, key: list, upto: int | None = None) -> DataFrame | None:
        """Merge on read of a keyed append-only table (a key occurs once in a part): the latest row of each key.

        The first part is streamed past the keys of later parts; only those are aggregated.
        """
        parts = [n for n in self._parts(table) if upto is None or n <= upto]
        if not parts:
            return None
        rows = self.read_parts(table, upto=upto)
        if len(parts) == 1:
            return rows.drop("seq")
        later = rows.where(F.col("seq") > parts[0])
        last = later.groupBy(*key).agg(F.max("seq").alias("seq"))
        first = rows.where(F.col("seq") == parts[0]).join(last.select(*key), key, "left_anti")
        return first.unionByName(later.join(last, [*key, "seq"], "left_semi")).drop("seq")

    def upsert(self, table: str, rows: DataFrame, key: list, partition_by: list | None = None, compact_after: int = 32) -> None:
        """Append ``rows`` (a key once) as a part: what is written is what is new. Every ``compact_after``
        parts the table is merged into one part, from which later reads start."""
        n = self.next_part(table)
        self.append(table, rows, n, partition_by)
        if len(self._parts(table)) >= compact_after:
            self.append(table, self.merged(table, key, upto=n), n + 1, partition_by)
            self._mark(table, n + 1)

    def clear(self, table: str, schema) -> int:
        """Publish an empty version (the old versions stay readable for time travel)."""
        return self.write(table, self.spark.createDataFrame([], schema))


def upsert(old: DataFrame | None, new: DataFrame, key: list) -> DataFrame:
    """Last write wins on ``key`` (rows of ``old`` whose key reappears in ``new`` are replaced)."""
    if old is None:
        return new
    return old.join(new.select(*key).distinct(), key, "left_anti").unionByName(new)


def upsert_latest(rows: DataFrame, key: list, seq_col: str = "write_seq") -> DataFrame:
    """Keep the row with the highest ``seq_col`` per key (a mergeable aggregate; no window)."""
    others = [c for c in rows.columns if c not in key]
    return (rows.groupBy(*key).agg(F.max_by(F.struct(*others), F.col(seq_col)).alias("_r"))
            .select(*key, "_r.*"))


def cache_split(requests: DataFrame, cache: DataFrame, key: list, force: bool = False,
                broadcast_max_rows: int = 2_000_000):
    """(hits, misses): requests found in the cache / to compute. ``force`` treats all as misses.

    A run's requests are few while the cache grows with every run: below the checked bound
    the request keys are broadcast against the cache (scanned, never shuffled) and only the
    keys found come back, themselves broadcast into the semi / anti joins.
    """
    if force:
        return requests.limit(0), requests
    req = requests.select(*key).distinct()
    if req.count() <= broadcast_max_rows:
        found = F.broadcast(cache.select(*key).join(F.broadcast(req), key).distinct())
    else:
        found = cache.select(*key).distinct()
    return requests.join(found, key, "left_semi"), requests.join(found, key, "left_anti")


def append_run(cache: DataFrame | None, rows: DataFrame, run_id: int) -> DataFrame:
    """Plain append tagged with ``run_id`` (a forced re-run adds a new run, it never mixes runs)."""
    tagged = rows.withColumn("run_id", F.lit(int(run_id)))
    return tagged if cache is None else cache.unionByName(tagged)


def latest_run(cache: DataFrame, key: list) -> DataFrame:
    """Rows of the latest run per key -- the read side of ``append_run``."""
    last = cache.groupBy(*key).agg(F.max("run_id").alias("run_id"))
    return cache.join(last, key + ["run_id"], "left_semi")


def needs_full_reembed(ideas: DataFrame, cached_vectors: DataFrame, model: str) -> bool:
    """IDF depends on N: any idea without a cached vector for ``model`` invalidates all vectors."""
    cached = cached_vectors.where(F.col("model") == model).select("idea_id")
    return cached.isEmpty() or not ideas.select("idea_id").join(cached, "idea_id", "left_anti").isEmpty()


def table_counts(tables: dict) -> DataFrame:
    """One row per table: (table_name, n)."""
    parts = [df.agg(F.count(F.lit(1)).cast("bigint").alias("n")).select(F.lit(name).alias("table_name"), "n")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
