"""Ingest: idea files, first-writer-wins dedup by url, surrogate ids, ingest report."""

from __future__ import annotations

from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage

RAW_SCHEMA = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("stack", T.StringType()),
])

IDEA_COLUMNS = ["idea_id", "title", "description", "source", "url", "category", "stack"]


def read_ideas_json(spark: SparkSession, path: str, multi_line: bool = True,
                    broadcast_max_rows: int = 2_000_000) -> DataFrame:
    """Read an ideas file: a bare JSON array of items, or an object with key ``ideas``.

    ``ingest_ord`` is the position in file order. An empty file is an error. At scale prefer
    JSON lines (``multi_line=False``): a multi-line document is parsed by one task per file.
    """
    wrapped = T.StructType([T.StructField("ideas", T.ArrayType(RAW_SCHEMA))])
    if multi_line:
        txt = spark.read.option("wholetext", True).text(path)
        first = F.regexp_extract(F.col("value"), r"^\s*(\S)", 1)
        arr = F.from_json(F.col("value"), T.ArrayType(RAW_SCHEMA))
        obj = F.from_json(F.col("value"), wrapped)
        items = txt.select(F.when(first == "[", arr).otherwise(obj.getField("ideas")).alias("items"),
                           F.col("_metadata.file_path").alias("_path"))
        df = items.select("_path", F.posexplode(F.coalesce("items", F.array())).alias("_pos", "item"))
        df = df.select("item.*", "_path", F.col("_pos").cast("bigint").alias("_at"))
    else:
        # a block of a file is read by one task from its start, so rows keep their order inside it,
        # and a block's start is above the row count of the blocks before it (a row has a byte or more)
        rows = spark.read.schema(RAW_SCHEMA).json(path).select(
            "*", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_row"))
        begin = cut_lineage(rows.groupBy("_path", "_block").agg(F.min("_row").alias("_begin"))
                            .select(F.col("_path").alias("_p"), F.col("_block").alias("_b"), "_begin"))
        # one row per block of input: below the bound the items stay where they are read
        small = F.broadcast(begin) if begin.count() <= broadcast_max_rows else begin
        df = (rows.join(small, (F.col("_path") == F.col("_p")) & (F.col("_block") == F.col("_b")))
              .select(*[f.name for f in RAW_SCHEMA], "_path", (F.col("_block") + F.col("_row") - F.col("_begin")).alias("_at")))
    if df.isEmpty():
        raise ValueError(f"nothing to ingest below {path}")
    # only the file names are numbered, not their contents
    names = df.select("_path") if multi_line else begin.select(F.col("_p").alias("_path"))
    files = cut_lineage(names.distinct().select(F.col("_path").alias("_p"),
                                                F.row_number().over(Window.orderBy("_path")).alias("_f")))
    files = F.broadcast(files) if files.count() <= broadcast_max_rows else files
    return df.join(files, F.col("_path") == F.col("_p")).select(
        *[f.name for f in RAW_SCHEMA], (F.col("_f").cast("bigint") * F.lit(1 << 40) + F.col("_at")).alias("ingest_ord"))


def loadable(ideas: DataFrame) -> DataFrame:
    """Ideas that take part in a run: a non-empty title or description."""
    return ideas.where((F.col("description") != "") | (F.col("title") != ""))


def normalise_raw(raw: DataFrame) -> DataFrame:
    """Defaults for optional fields; keeps ``ingest_ord`` and a ``rejected`` flag for null required fields."""
    cols = raw.columns
    cat = F.coalesce(F.col("category"), F.lit("")) if "category" in cols else F.lit("")
    stk = F.coalesce(F.col("stack"), F.lit("")) if "stack" in cols else F.lit("")
    rejected = (F.col("title").isNull() | F.col("description").isNull() | F.col("source").isNull()
                | F.col("url").isNull())
    return raw.select("title", "description", "source", "url", cat.alias("category"), stk.alias("stack"),
                      F.col("ingest_ord").cast("bigint"), rejected.alias("rejected"))


class IngestResult(NamedTuple):
    new_ideas: DataFrame  # IDEA_COLUMNS + ingest_ord
    report: DataFrame  # source, fetched, new, duplicates, rejected


def row_keys(norm: DataFrame) -> DataFrame:
    """``(ingest_ord, _tie, url, source, rejected)`` per row: what dedup, numbering and report need, no text.

    ``_tie`` hashes the whole row, so ``(ingest_ord, _tie)`` finds a row again and settles rows that
    share an ``ingest_ord``; only repeats of one row share both.
    """
    cols = [c for c in norm.columns if c not in ("ingest_ord", "rejected")]
    return norm.select("ingest_ord", F.xxhash64(*cols).alias("_tie"), "url", "source", "rejected")


def first_wins(keys: DataFrame, existing_urls: DataFrame | None, broadcast_max_rows: int = 2_000_000) -> DataFrame:
    """Keys of the rows that a url-unique insert would accept, in a batch applied in ``(ingest_ord, _tie)``
    order, with the number ``_n`` of rows each stands for.

    Non-empty urls: the first row per url wins (``_n`` = 1), and urls already stored lose. Empty urls never
    collide and are left out of that aggregation, where they would be one giant key; repeats of one such row
    all stay. A null ``ingest_ord`` comes first.

    Against a large stored table, a batch whose url count is within ``broadcast_max_rows``
    probes the stored urls with a broadcast of its own urls (the stored table is scanned,
    never shuffled), and only the few colliding urls are anti-joined back.
    """
    ok = keys.where(~F.col("rejected"))
    keyed = ok.where(F.col("url") != "")
    blank = ok.where(F.col("url") == "")
    winners = (keyed.groupBy("url").agg(F.min(F.struct("ingest_ord", "_tie", "source")).alias("w"))
               .select("url", "w.*", F.lit(1).cast("bigint").alias("_n")))
    if existing_urls is not None:
        stored = existing_urls.select("url").where(F.col("url") != "")
        # the batch's row count bounds its distinct urls and needs no shuffle to compute
        if keyed.count() <= broadcast_max_rows:
            dups = stored.join(F.broadcast(winners.select("url")), "url").distinct()
            winners = winners.join(F.broadcast(dups), "url", "left_anti")
        else:
            winners = winners.join(stored.distinct(), "url", "left_anti")
    return winners.unionByName(blank.groupBy("ingest_ord", "_tie", "source").agg(F.count(F.lit(1)).alias("_n"))
                               .withColumn("url", F.lit("")))


def assign_ids(keys: DataFrame, start_after: int, partitions: int | None = None) -> DataFrame:
    """Dense ids ``start_after+1, ...`` in ``(ingest_ord, _tie)`` order, without a global window; a key that
    stands for ``_n`` rows takes as many ids and gets the first as ``idea_id``.

    Range-partition the keys, checkpoint (so partition contents are fixed even if a task is re-run), count
    ids per partition, then number inside each partition from the partition's offset.
    """
    p = partitions or int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut_lineage(keys.repartitionByRange(p, "ingest_ord", "_tie").sortWithinPartitions("ingest_ord", "_tie")
                         .withColumn("_pid", F.spark_partition_id()))
    counts = sorted((r["_pid"], r["n"]) for r in ranged.groupBy("_pid").agg(F.sum("_n").alias("n")).collect())
    offsets, acc = {}, start_after
    for pid, n in counts:
        offsets[pid] = acc
        acc += n
    schema = T.StructType(ranged.schema.fields + [T.StructField("idea_id", T.LongType())])

    def number(batches):
        given = 0  # a partition is read in its checkpointed, sorted order
        for b in batches:
            if b.num_rows:
                n = b.column("_n").to_numpy()
                ends = n.cumsum() + given
                ids = pa.array(ends - n + offsets[b.column("_pid")[0].as_py()] + 1, pa.int64())
                given = int(ends[-1])
                yield pa.RecordBatch.from_arrays([*b.columns, ids], names=schema.names)

    return ranged.mapInArrow(number, schema).drop("_pid")


def rows_of(norm: DataFrame, numbered: DataFrame) -> DataFrame:
    """The rows of the numbered keys with their ``idea_id``; repeats of a row take the ids of their key in turn.

    This is the one place where texts move: a hash join on ``(ingest_ord, _tie)``. The copy number is
    counted in the partitions and order that the join leaves.
    """
    cols = [c for c in norm.columns if c not in ("ingest_ord", "rejected")]
    rows = norm.where(~F.col("rejected")).select(*cols, F.col("ingest_ord"), F.xxhash64(*cols).alias("_tie"))
    k = numbered.select(F.col("ingest_ord").alias("_o"), F.col("_tie").alias("_t"), "_n", "idea_id")
    met = rows.join(k, F.col("ingest_ord").eqNullSafe(F.col("_o")) & (F.col("_tie") == F.col("_t")))
    at = F.row_number().over(Window.partitionBy("ingest_ord", "_tie").orderBy("idea_id"))
    return (met.withColumn("_c", at).where(F.col("_c") <= F.col("_n"))
            .withColumn("idea_id", F.col("idea_id") + F.col("_c") - 1).select("idea_id", *cols, "ingest_ord"))


def ingest(raw: DataFrame, existing: DataFrame | None = None, max_existing_id: int | None = None) -> IngestResult:
    """Bulk insert with first-writer-wins dedup by non-empty url; returns new ideas and a report.

    Dedup, numbering and report work on checkpointed keys; texts are read once for the keys and once,
    with the winners, for the rows. ``raw`` must therefore give the same rows each time it is read.
    """
    norm = normalise_raw(raw)
    keys = cut_lineage(row_keys(norm))
    if max_existing_id is None:
        max_existing_id = 0
        if existing is not None and "idea_id" in existing.columns:
            max_existing_id = existing.agg(F.max("idea_id")).first()[0] or 0
    numbered = assign_ids(first_wins(keys, existing), int(max_existing_id))
    return IngestResult(rows_of(norm, numbered).select(*IDEA_COLUMNS, "ingest_ord"), ingest_report(keys, numbered))


def ingest_report(keys: DataFrame, numbered: DataFrame) -> DataFrame:
    """Per source and total: fetched, new, duplicates, rejected (one aggregate of keys, no join of rows)."""
    both = (keys.select("source", F.lit(1).cast("bigint").alias("f"), F.lit(0).cast("bigint").alias("is_new"), "rejected")
            .unionByName(numbered.select("source", F.lit(0).cast("bigint").alias("f"), F.col("_n").alias("is_new"),
                                         F.lit(False).alias("rejected"))))
    rep = (both.rollup("source").agg(
        F.sum("f").alias("fetched"),
        F.sum("is_new").alias("new"),
        F.sum(F.when(F.col("rejected"), 1).otherwise(0)).alias("rejected"),
        F.grouping("source").alias("_g")))
    return rep.select(F.when(F.col("_g") == 1, F.lit("TOTAL")).otherwise(F.col("source")).alias("source"),
                      F.col("fetched").cast("bigint"), F.col("new").cast("bigint"),
                      (F.col("fetched") - F.col("new") - F.col("rejected")).cast("bigint").alias("duplicates"),
                      F.col("rejected").cast("bigint"))


def has_new(new_ideas: DataFrame) -> bool:
    """Downstream refresh guard: skip the run when nothing was inserted."""
    return not new_ideas.isEmpty()
