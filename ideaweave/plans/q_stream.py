"""Queries: streaming ingest, windowed cost ledger and refresh guard (L1-L3), final state."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.store import SnapshotStore
from ..sources import testdata as td
from ..streaming import jobs
from . import oracle_views as ov
from .registry import query


def _landed(d, name):
    """A table as a stream source: a pattern, since a stream takes a single file by pattern only (a folder either way)."""
    return f"{d}/{name}.parque[t]"


def _ingest_once(spark, d, store_root, on_new=None):
    sch = td.table(spark, d, "documents").schema
    q = jobs.start_ingest(spark, _landed(d, "documents"), sch, store_root, jobs.scratch(spark, "ckpt-ingest"),
                          on_new=on_new, transform=td.raw_from_documents)
    q.awaitTermination()


@query("stream_ingest", """
WITH r AS (SELECT 'doc:' || sha256(text) AS url, source, doc_id AS ingest_ord FROM documents),
f AS (SELECT url, arg_min(source, ingest_ord) AS source, min(ingest_ord) AS ingest_ord FROM r GROUP BY url)
SELECT row_number() OVER (ORDER BY ingest_ord)::BIGINT AS idea_id, url, source, ingest_ord FROM f""")
def stream_ingest(spark, d):
    root = jobs.scratch(spark, "store")
    _ingest_once(spark, d, root)
    return SnapshotStore(spark, root).read_parts("ideas").select("idea_id", "url", "source", "ingest_ord")


@query("stream_refresh", """
SELECT 1 AS run, (SELECT count(DISTINCT sha256(text)) FROM documents)::BIGINT AS new_rows, true AS refreshed
UNION ALL SELECT 2, 0::BIGINT, false""")
def stream_refresh(spark, d):
    """Two weekly runs over the same landed files: the second inserts nothing and skips the refresh."""
    root = jobs.scratch(spark, "store")
    seen = []
    _ingest_once(spark, d, root, on_new=lambda new, bid: seen.append(bid))
    _ingest_once(spark, d, root, on_new=lambda new, bid: seen.append(bid))
    log = SnapshotStore(spark, root).read_parts("batch_log")
    return log.select(F.col("seq").cast("int").alias("run"), "new_rows", "refreshed")


@query("stream_cost_windows", f"""WITH {ov.LEDGER},
pr AS (SELECT l.ts, l.stage, l.input_tokens, l.output_tokens,
              l.input_tokens / 1000000.0::DOUBLE * p.input_per_million
              + l.output_tokens / 1000000.0::DOUBLE * p.output_per_million AS cost
       FROM ledger_v l JOIN pricing_v p USING (model)),
g AS (SELECT date_trunc('day', ts) AS ws, stage, sum(cost) AS cost, sum(input_tokens) AS input_tokens,
             sum(output_tokens) AS output_tokens FROM pr GROUP BY date_trunc('day', ts), stage)
SELECT CAST(epoch(ws) AS BIGINT) AS window_start, stage, round(cost, 6) AS cost,
       input_tokens::BIGINT AS input_tokens, output_tokens::BIGINT AS output_tokens
FROM g WHERE ws + INTERVAL 1 DAY <= (SELECT max(ts) FROM pr) - INTERVAL 1 HOUR""")
def stream_cost_windows(spark, d):
    sch = td.table(spark, d, "events").schema
    ev = spark.readStream.schema(sch).parquet(_landed(d, "events"))
    out = jobs.scratch(spark, "cost-windows")
    jobs.run_to_table(jobs.cost_windows(td.ledger_from_events(ev)), jobs.scratch(spark, "ckpt-cost"), out)
    r = spark.read.parquet(out)
    return r.select(F.unix_seconds("w.start").alias("window_start"), "stage",
                    F.round("cost", 6).alias("cost"), F.col("input_tokens").cast("bigint"),
                    F.col("output_tokens").cast("bigint"))


@query("stream_horizon_dedup", """
WITH r AS (SELECT 'doc:' || sha256(text) AS url, source, doc_id AS ingest_ord, doc_id * 60 AS sec FROM documents
           WHERE text IS NOT NULL AND doc_id IS NOT NULL),
g AS (SELECT *, CASE WHEN sec - lag(sec) OVER (PARTITION BY url ORDER BY sec, ingest_ord) <= 3600 THEN 0 ELSE 1 END AS opens FROM r),
s AS (SELECT *, sum(opens) OVER (PARTITION BY url ORDER BY sec, ingest_ord) AS run FROM g)
SELECT url, arg_min(source, ingest_ord) AS source, min(ingest_ord) AS ingest_ord, count(*)::BIGINT AS n_seen,
       (max(sec) - min(sec))::BIGINT AS seen_for
FROM s GROUP BY url, run HAVING max(sec) + 3600 <= (SELECT max(sec) FROM r) - 600""")
def stream_horizon_dedup(spark, d):
    """A stream of items with a fetch time (a minute per id), deduplicated by url within an hour.

    Runs still open at the last watermark (ten minutes behind the newest row) stay in the state.
    """
    docs = spark.readStream.schema(td.table(spark, d, "documents").schema).parquet(_landed(d, "documents"))
    items = td.raw_from_documents(docs).select("url", "source", "ingest_ord",
                                               F.timestamp_seconds(F.col("ingest_ord") * 60).alias("fetched_at"))
    out = jobs.scratch(spark, "horizon")
    jobs.run_to_table(jobs.horizon_dedup(items, "1 hour", "10 minutes"), jobs.scratch(spark, "ckpt-horizon"), out)
    return spark.read.parquet(out).select(
        "url", "source", "ingest_ord", "n_seen",
        (F.unix_seconds("last_seen") - F.unix_seconds("fetched_at")).alias("seen_for"))
