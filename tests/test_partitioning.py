"""Results do not depend on the number of shuffle partitions (1 vs 8)."""

import math

import pytest

import __spark_entry__ as E

from .conftest import SF001


def _rows(df):
    def norm(v):
        return round(v, 9) if isinstance(v, float) and not math.isnan(v) else v
    return sorted((tuple(norm(x) for x in r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("name", ["tfidf_weights", "neighborhoods_capped", "neighborhoods_lcg", "ingest_dedup",
                                  "cluster_prompt", "src_github"])
def test_partition_count_independent(spark, name):
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        one = _rows(E.queries()[name](spark, SF001))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert one == _rows(E.queries()[name](spark, SF001))


def test_new_idea_invalidates_embedding_cache(spark, tmpdir_path):
    from ideaweave.config import DEFAULT_CONFIG
    from ideaweave.operators.store import SnapshotStore
    from ideaweave.plans import pipeline as pl
    rows = [(i, f"title {i % 5} word{i % 3}", f"desc about topic{i % 5} and thing{i % 4}", "s", f"u{i}", "", "")
            for i in range(20)]
    schema = "idea_id long, title string, description string, source string, url string, category string, stack string"
    store = SnapshotStore(spark, tmpdir_path)
    cfg = DEFAULT_CONFIG.replace(num_clusters=3)
    assert not pl.stage1(spark.createDataFrame(rows, schema), cfg, store=store).reused
    assert pl.stage1(spark.createDataFrame(rows, schema), cfg, store=store).reused
    more = rows + [(99, "title new", "desc about topic9", "s", "u99", "", "")]
    s1 = pl.stage1(spark.createDataFrame(more, schema), cfg, store=store)
    assert not s1.reused and s1.vectors.n_docs == 21
