import os

from pyspark.sql import functions as F

from ideaweave.operators.store import SnapshotStore
from ideaweave.streaming import jobs

SCHEMA = "title string, description string, url string, source string, category string, stack string, ingest_ord long"


def test_ingest_stream_is_idempotent(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "landing")
    spark.createDataFrame([("a", "d", "u1", "s", None, None, 1), ("b", "d", "u1", "s", None, None, 2),
                           ("c", "d", "u2", "s", None, None, 3)], SCHEMA).write.parquet(src + "/batch1")
    root = os.path.join(tmpdir_path, "store")
    ck = os.path.join(tmpdir_path, "ck")
    jobs.start_ingest(spark, src + "/batch1", spark.read.parquet(src + "/batch1").schema, root, ck).awaitTermination()
    jobs.start_ingest(spark, src + "/batch1", spark.read.parquet(src + "/batch1").schema, root, ck).awaitTermination()
    ideas = SnapshotStore(spark, root).read_parts("ideas")
    assert sorted((r["idea_id"], r["title"]) for r in ideas.collect()) == [(1, "a"), (2, "c")]
    # the same files landing again under a new stream add nothing
    jobs.start_ingest(spark, src + "/batch1", spark.read.parquet(src + "/batch1").schema, root,
                      os.path.join(tmpdir_path, "ck2")).awaitTermination()
    assert SnapshotStore(spark, root).read_parts("ideas").count() == 2
    log = SnapshotStore(spark, root).read_parts("batch_log")
    assert sorted((r["seq"], r["new_rows"], r["refreshed"]) for r in log.collect()) == [(1, 2, False), (2, 0, False)]


def test_cost_windows_drop_late_rows(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "ledger")
    rows = [("2024-01-01 10:00:00", "claude-haiku-4-5-20251001", "a", 1_000_000, 0),
            ("2024-01-03 10:00:00", "claude-haiku-4-5-20251001", "a", 1_000_000, 0)]
    df = spark.createDataFrame(rows, "ts string, model string, stage string, input_tokens long, output_tokens long") \
        .withColumn("ts", F.to_timestamp("ts"))
    df.write.parquet(src + "/p1")
    stream = spark.readStream.schema(df.schema).parquet(src + "/p1")
    out = os.path.join(tmpdir_path, "out")
    jobs.run_to_table(jobs.cost_windows(stream), os.path.join(tmpdir_path, "ck"), out)
    got = spark.read.parquet(out).select(F.unix_seconds("w.start").alias("d"), "cost").collect()
    assert [(r["d"], round(r["cost"], 6)) for r in got] == [(1704067200, 0.8)]


def _crash(spark, root, rows, at):
    """Run a batch that fails ``at`` its part write or log write, then replay it."""
    store = SnapshotStore(spark, root)
    raw = spark.createDataFrame(rows, SCHEMA)
    seen = []

    class Broken(SnapshotStore):
        def append(self, table, df, seq):
            if table == at:
                raise OSError("lost")
            super().append(table, df, seq)

    try:
        jobs.ingest_batch(Broken(spark, root), raw, 0, on_new=lambda new, bid: seen.append(bid), run_key="s")
    except OSError:
        pass
    n = jobs.ingest_batch(store, raw, 0, on_new=lambda new, bid: seen.append(bid), run_key="s")
    assert jobs.ingest_batch(store, raw, 0, on_new=lambda new, bid: seen.append(bid), run_key="s") == 0
    ideas = sorted((r["idea_id"], r["title"]) for r in store.read_parts("ideas").collect())
    log = [(r["new_rows"], r["refreshed"]) for r in store.read_parts("batch_log").collect()]
    return n, ideas, log, seen


def test_replay_after_a_crash(spark, tmpdir_path):
    plain = [("a", "d", "u1", "s", None, None, 1), ("b", "d", "u1", "s", None, None, 2)]
    blank = plain + [("c", "d", "", "s", None, None, 3)]
    for k, (rows, at) in enumerate([(plain, "ideas"), (plain, "batch_log"), (blank, "ideas"), (blank, "batch_log")]):
        n, ideas, log, seen = _crash(spark, os.path.join(tmpdir_path, str(k)), rows, at)
        want = [(1, "a")] + ([(2, "c")] if rows is blank else [])
        assert (n, ideas, log) == (len(want), want, [(len(want), True)])
        assert seen == ([0] if at == "ideas" else [0, 0])


def _items(spark, rows):
    return spark.createDataFrame(rows, "url string, ingest_ord long, at long").select(
        "url", "ingest_ord", F.timestamp_seconds("at").alias("fetched_at"))


def test_horizon_dedup_equals_brute_force(spark, tmpdir_path):
    import random
    draw = random.Random(5)
    rows = [(draw.choice(["", "a", "b", "c", "d", None]), i, draw.choice([i * 40, i * 40 + draw.randrange(600)])) for i in range(400)]
    rows += rows[::50]  # repeated rows
    want, last = [], {}
    for url, i, at in sorted((r for r in rows if r[0]), key=lambda r: (r[2], r[1])):
        if url not in last or at - last[url][0] > 100:
            want.append([url, i, at, 0, at])
            last[url] = [at, len(want) - 1]
        run = want[last[url][1]]
        run[3], run[4], last[url][0] = run[3] + 1, at, at
    want += [[u, i, at, 1, at] for u, i, at in rows if u == ""]
    got = jobs.horizon_dedup(_items(spark, rows), "100 seconds", "1 hour").select(
        "url", "ingest_ord", F.unix_seconds("fetched_at"), "n_seen", F.unix_seconds("last_seen")).collect()
    assert sorted(map(list, got)) == sorted(want)


def test_horizon_dedup_of_a_stream_counts_late_rows(spark, tmpdir_path):
    src, ck, out = (os.path.join(tmpdir_path, x) for x in ("in", "ck", "out"))
    lots = [[("a", 1, 0), ("a", 2, 50), ("b", 3, 60), ("", 4, 60)], [("a", 5, 130), ("z", 6, 1000)],
            [("a", 7, 140), ("a", 8, 2000), ("", 9, 2000)]]
    late = []
    for rows in lots:  # a run of the job per landing, from the same checkpoint
        _items(spark, rows).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema("url string, ingest_ord long, fetched_at timestamp").parquet(src)
        late.append(jobs.run_to_table(jobs.horizon_dedup(stream, "100 seconds", "10 seconds"), ck, out))
    got = spark.read.parquet(out).select("url", "ingest_ord", "n_seen").collect()
    assert sorted(map(tuple, got)) == [("", 4, 1), ("", 9, 1), ("a", 1, 3), ("b", 3, 1), ("z", 6, 1)]
    assert late == [0, 0, 1]  # item 7 came after its run was closed; item 8 is still open
