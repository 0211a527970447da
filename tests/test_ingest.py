import json
import os

import pytest
from pyspark.sql import functions as F

from ideaweave.operators import ingest as ing

SCHEMA = "title string, description string, url string, source string, category string, stack string, ingest_ord long"


def test_first_writer_wins_and_blank_urls(spark):
    raw = spark.createDataFrame([
        ("a", "d", "u1", "gh", None, None, 1), ("b", "d", "u1", "hn", "x", None, 2),
        ("c", "d", "", "gh", None, None, 3), ("d", "d", "", "gh", None, None, 4),
        (None, "d", "u9", "gh", None, None, 5), ("e", "d", "u2", "gh", None, None, 6),
        ("f", "d", "u3", "gh", None, None, 7)], SCHEMA)
    existing = spark.createDataFrame([(10, "u3")], "idea_id long, url string")
    res = ing.ingest(raw, existing)
    rows = sorted((r["ingest_ord"], r["idea_id"], r["title"], r["category"]) for r in res.new_ideas.collect())
    assert rows == [(1, 11, "a", ""), (3, 12, "c", ""), (4, 13, "d", ""), (6, 14, "e", "")]
    rep = {r["source"]: (r["fetched"], r["new"], r["duplicates"], r["rejected"]) for r in res.report.collect()}
    assert rep["TOTAL"] == (7, 4, 2, 1)
    assert rep["hn"] == (1, 0, 1, 0)


def test_ids_follow_ingest_order_across_partitions(spark):
    raw = spark.range(0, 5000).select(F.concat(F.lit("t"), F.col("id").cast("string")).alias("title"),
                                      F.lit("d").alias("description"),
                                      F.concat(F.lit("u"), (F.col("id") % 3000).cast("string")).alias("url"),
                                      F.lit("s").alias("source"), F.lit(None).cast("string").alias("category"),
                                      F.lit(None).cast("string").alias("stack"), (F.lit(5000) - F.col("id")).alias("ingest_ord"))
    new = ing.ingest(raw.repartition(7)).new_ideas
    got = sorted((r["ingest_ord"], r["idea_id"]) for r in new.collect())
    assert [i for _, i in got] == list(range(1, 3001))
    assert got[0][0] == 1


def test_read_ideas_json(spark, tmpdir_path):
    p1 = os.path.join(tmpdir_path, "a.json")
    with open(p1, "w") as f:
        json.dump([{"title": "x", "description": "y", "url": "u", "source": "s"}], f)
    p2 = os.path.join(tmpdir_path, "b.json")
    with open(p2, "w") as f:
        json.dump({"ideas": [{"title": "x2", "description": "y", "url": "u2", "source": "s"},
                             {"title": "x3", "description": "y", "url": "u3", "source": "s"}]}, f)
    assert ing.read_ideas_json(spark, p1).count() == 1
    assert [r["title"] for r in ing.read_ideas_json(spark, p2).orderBy("ingest_ord").collect()] == ["x2", "x3"]
    p3 = os.path.join(tmpdir_path, "c.json")
    with open(p3, "w") as f:
        f.write("[]")
    with pytest.raises(ValueError):
        ing.read_ideas_json(spark, p3)


def test_loadable_filter(spark):
    df = spark.createDataFrame([(1, "", ""), (2, "t", ""), (3, "", "d")], "idea_id long, title string, description string")
    assert sorted(r[0] for r in ing.loadable(df).collect()) == [2, 3]


def test_repeated_rows_and_shared_positions(spark):
    rows = [("a", "d", "", "s", None, None, 1)] * 3 + [("b", "d", "u", "s", None, None, 2)] * 2 \
        + [("c", "d", "u", "s", None, None, 2), ("d", "d", "v", "s", None, None, 2), ("e", "d", "w", "s", None, None, None)]
    got = [[(r["idea_id"], r["title"]) for r in ing.ingest(spark.createDataFrame(rows[::k], SCHEMA).repartition(3))
            .new_ideas.orderBy("idea_id").collect()] for k in (1, -1)]
    assert got[0] == got[1]
    assert [t for _, t in got[0]][:4] == ["e", "a", "a", "a"] and [i for i, _ in got[0]] == list(range(1, 7))
    assert sorted(t for _, t in got[0][4:])[1] == "d" and len(got[0]) == 6
    rep = {r["source"]: (r["fetched"], r["new"], r["duplicates"]) for r in
           ing.ingest(spark.createDataFrame(rows, SCHEMA)).report.collect()}
    assert rep["TOTAL"] == (8, 6, 2)


def test_empty_batch(spark):
    res = ing.ingest(spark.createDataFrame([], SCHEMA), spark.createDataFrame([(10, "u3")], "idea_id long, url string"))
    assert res.new_ideas.collect() == [] and not ing.has_new(res.new_ideas)


def test_texts_stay_out_of_aggregates_range_shuffles_and_checkpoints(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(ing, "cut_lineage", lambda df: (seen.append(df), df)[1])
    raw = spark.range(2000).select(F.lit("t").alias("title"), F.lit("d").alias("description"),
                                   F.concat(F.lit("u"), (F.col("id") % 300).cast("string")).alias("url"), F.lit("s").alias("source"),
                                   F.col("id").alias("ingest_ord"))
    res = ing.ingest(raw)
    assert len(seen) == 2 and not any({"title", "description", "category", "stack"} & set(df.columns) for df in seen)
    plan = res.new_ideas._jdf.queryExecution().executedPlan().toString()
    assert "min_by" not in plan and not [x for x in plan.splitlines() if "Aggregate(" in x and "title" in x]


def test_json_lines_stay_where_they_are_read(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "lines")
    spark.range(500).select(F.col("id").cast("string").alias("title"), F.lit("d").alias("description"),
                            F.col("id").cast("string").alias("url"), F.lit("s").alias("source")).coalesce(1).write.json(path)
    raw = ing.read_ideas_json(spark, path, multi_line=False)
    assert "Exchange hashpartitioning" not in raw._jdf.queryExecution().executedPlan().toString()
    assert [r["title"] for r in raw.orderBy("ingest_ord").collect()] == [str(i) for i in range(500)]
