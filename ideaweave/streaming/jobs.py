"""Structured Streaming jobs (L1-L3): the recurring batch as streams.

* ``start_ingest``: file stream of raw items -> ``foreachBatch`` first-writer-wins insert into
  a snapshot table. Each batch id is written at most once (a marker per batch id makes a
  replayed batch a no-op), so a restart after a failure never double-inserts. Dedup is
  against the whole stored table (the unique-url rule has no horizon, so no watermark
  dedup is used).
* ``cost_windows``: stream-static join with the price list, event-time windows per stage with
  a watermark; append mode emits a window once the watermark passes its end, later rows
  for a closed window are dropped.
* ``refresh``: runs a downstream callable only for batches that inserted rows.

``Trigger.AvailableNow`` gives the weekly-run behaviour: process what has landed, then stop.
Checkpoints and tables live under the shared folder named by ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import uuid
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import ingest as ing
from ..operators import ledger as led
from ..operators.store import SnapshotStore
from ..session import ensure_checkpointing


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh (not yet existing) path under the shared checkpoint folder; writers create it."""
    ensure_checkpointing(spark)
    return f"{spark.sparkContext.getCheckpointDir().rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def _done_batches(store: SnapshotStore, run_key: str) -> set:
    log = store.read_parts("batch_log")
    if log is None:
        return set()
    return {r[0] for r in log.where(F.col("run_key") == run_key).select("batch_id").collect()}


def ingest_batch(store: SnapshotStore, raw: DataFrame, batch_id: int, on_new: Callable | None = None,
                 transform: Callable | None = None, run_key: str = "") -> int:
    """Insert one micro-batch (idempotent per stream and batch id); returns the number of new ideas.

    The ideas table is append-only: a batch writes only its new rows as one part, so the work per
    batch is the batch plus one scan of the stored urls (probed with the batch's urls).
    ``run_key`` names the stream (its checkpoint), since batch ids restart with a new checkpoint.
    A logged batch id is skipped. A batch that failed before its log entry has the same number in
    the replay: its own part is left out of the stored urls, written again with the same rows and
    ids, and ``on_new`` is called for it (again, if the failure came after the call).
    """
    if batch_id in _done_batches(store, run_key):
        return 0
    if transform is not None:
        raw = transform(raw)
    log = store.read_parts("batch_log")
    seq = 1 if log is None else log.count() + 1
    existing = store.read_parts("ideas", before=seq)
    max_id = 0 if existing is None else (existing.agg(F.max("idea_id")).first()[0] or 0)
    res = ing.ingest(raw, existing.select("url") if existing is not None else None, max_existing_id=max_id)
    new = res.new_ideas.cache()
    n = new.count()
    if n:
        store.append("ideas", new, seq)
    refreshed = False
    if n and on_new is not None:
        on_new(new, batch_id)
        refreshed = True
    spark = raw.sparkSession
    entry = spark.createDataFrame([(seq, run_key, int(batch_id), int(n), refreshed)],
                                  "seq long, run_key string, batch_id long, new_rows long, refreshed boolean")
    store.append("batch_log", entry.drop("seq"), seq)
    new.unpersist()
    return n


def start_ingest(spark: SparkSession, source_dir: str, schema, store_root: str, checkpoint: str,
                 glob: str | None = None, on_new: Callable | None = None, available_now: bool = True,
                 transform: Callable | None = None):
    """Stream raw-item files into the ideas snapshot table; returns the StreamingQuery."""
    store = SnapshotStore(spark, store_root)
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    stream = reader.parquet(source_dir)
    w = stream.writeStream.foreachBatch(lambda df, bid: ingest_batch(store, df, bid, on_new, transform, checkpoint)) \
        .option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def cost_windows(ledger_stream: DataFrame, window: str = "1 day", delay: str = "1 hour") -> DataFrame:
    """Windowed cost and tokens per stage from a streaming ledger ``(ts, model, stage, tokens)``."""
    # a timestamp_ntz wall time is taken as UTC, whatever the session time zone
    ts = ledger_stream.withColumn(
        "ts", F.col("ts") if dict(ledger_stream.dtypes)["ts"] == "timestamp"
        else F.timestamp_micros(F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', ts)")))
    priced = ts.join(F.broadcast(led.pricing(ledger_stream.sparkSession)), "model").withColumn("cost", led.cost_col())
    return (priced.withWatermark("ts", delay).groupBy(F.window("ts", window).alias("w"), "stage")
            .agg(F.sum("cost").alias("cost"), F.sum("input_tokens").alias("input_tokens"),
                 F.sum("output_tokens").alias("output_tokens")))


def horizon_dedup(items: DataFrame, horizon: str, delay: str, ts: str = "fetched_at", key: str = "url",
                  order: str = "ingest_ord") -> DataFrame:
    """First-writer-wins per ``key`` within a horizon: a row is a repeat if the row before it of the same key, by
    event time, is at most ``horizon`` older. Returns the first row of each run with ``n_seen``, ``last_seen``.

    A run is a session window with gap ``horizon``, so the result does not depend on how the stream was
    cut into batches or on the order inside them. State is one row per open run; the watermark
    (``delay`` behind the newest event) closes runs and drops rows that come later than that, which
    ``run_to_table`` counts. Rows with equal times go by ``order``, then by a hash of the row. Rows with an
    empty key pass at once, each as a run of its own; rows with a null key or time are left out.
    Works alike on a table that is not a stream (all runs closed).
    """
    rest = [c for c in items.columns if c not in (key, ts)]
    ok = items.where(F.col(key).isNotNull() & F.col(ts).isNotNull()).withWatermark(ts, delay)
    first = F.min_by(F.struct(*rest), F.struct(F.col(ts), F.col(order), F.xxhash64(*rest)))
    runs = (ok.where(F.col(key) != "").groupBy(F.session_window(ts, horizon).alias("w"), key)
            .agg(first.alias("r"), F.min(ts).alias("_from"), F.max(ts).alias("last_seen"),
                 F.count(F.lit(1)).alias("n_seen"))
            .select(F.col(key), F.col("_from").alias(ts), "r.*", "n_seen", "last_seen"))
    single = ok.where(F.col(key) == "").select(key, ts, *rest, F.lit(1).cast("bigint").alias("n_seen"),
                                               F.col(ts).alias("last_seen"))
    return runs.unionByName(single)


def run_to_table(df: DataFrame, checkpoint: str, out_dir: str) -> int:
    """Append-mode sink to Parquet, processing everything available, then stop; returns the number of
    rows that stateful operators dropped as late (after their partial aggregation)."""
    q = (df.writeStream.outputMode("append").format("parquet").option("path", out_dir)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return sum(op["numRowsDroppedByWatermark"] for p in q.recentProgress for op in p["stateOperators"])
