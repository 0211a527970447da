"""Physical-plan properties the scale design relies on (checked on the smallest tables)."""

from pyspark.sql import functions as F
import pytest

import __spark_entry__ as E

from .conftest import SF001


def _plan(spark, name):
    df = E.queries()[name](spark, SF001)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["tfidf_weights", "ingest_report", "cost_by_stage", "parse_constellations",
                                  "export_ideas", "src_hn", "src_github", "member_titles", "set_hash"])
def test_no_row_udfs_or_cartesian(spark, name):
    plan = _plan(spark, name)
    for bad in ("CartesianProduct", "BatchEvalPython", "BroadcastNestedLoopJoin"):
        assert bad not in plan, (name, bad)


def test_tfidf_partial_aggregation_and_pruning(spark):
    from ideaweave.operators import tfidf as tf
    from ideaweave.sources import testdata as td
    counts = tf.term_frequencies(tf.tokens(tf._dealt(tf.documents(td.ideas(spark, SF001)))))
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan  # (doc, term) counted where the document is
    assert plan.count("Exchange") == 1 and "ReadSchema: struct<doc_id:bigint,text:string,lang:string>" in plan  # no other column read
    assert "BroadcastHashJoin" in _plan(spark, "tfidf_weights")  # vocabulary below the checked row bound


def test_price_list_is_broadcast(spark):
    plan = _plan(spark, "cost_by_stage")
    assert "BroadcastHashJoin" in plan and "partial_sum" in plan
    assert "ReadSchema: struct<user_id:bigint,event_type:string,value:double>" in plan


def test_per_fetch_caps_limit_before_shuffle(spark):
    from ideaweave.sources import normalise as nz
    rows = spark.range(1000).select((F.col("id") % 3).alias("fetch_key"), F.col("id").alias("pos"))
    plan = nz._top_per_fetch(rows, 500)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert "WindowGroupLimit" not in _plan(spark, "src_hn")  # no cap by default


def test_export_keeps_texts_out_of_the_aggregate(spark):
    plan = _plan(spark, "export_ideas")
    assert "partial_min(idea_id" in plan and "min_by" not in plan  # ids alone are aggregated


def test_prompt_lines_stream_the_ideas_table(spark):
    plan = _plan(spark, "neighborhood_prompt")
    # the bounded member list is broadcast; the documents scan feeds a broadcast hash join
    assert "BroadcastHashJoin" in plan
    assert "Exchange hashpartitioning(idea_id" not in plan
