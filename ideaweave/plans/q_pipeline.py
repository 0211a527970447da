"""Queries: the end-to-end run over stored replies (rows-only checks)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import DEFAULT_CONFIG
from ..operators import discovery as disc
from ..sources import testdata as td
from . import pipeline as pl
from .registry import query


def _run(spark, d):
    return pl.run(td.ideas(spark, d), disc.StoredReplies(td.stored_replies), DEFAULT_CONFIG)


@query("flagship")
def flagship(spark, d):
    """Constellations found over the documents corpus (stages 1-3)."""
    c = _run(spark, d).constellations
    return c.select("neighborhood_hash", F.col("item_ord").cast("int"), "constellation_type",
                    F.array_join(F.transform("idea_ids", lambda x: x.cast("string")), ",").alias("idea_ids"),
                    "title", "score", "actionability", "model", "prompt_version")


@query("pipeline_patterns")
def pipeline_patterns(spark, d):
    p = _run(spark, d).patterns
    return p.select("cluster_hash", F.col("item_ord").cast("int"), "pattern_title", "pattern_description",
                    F.array_join(F.transform("idea_ids", lambda x: x.cast("string")), ",").alias("idea_ids"))


@query("pipeline_metadata")
def pipeline_metadata(spark, d):
    m = _run(spark, d).metadata
    return m.drop("elapsed_ms").withColumn("constellations_by_type", F.to_json("constellations_by_type"))


@query("pipeline_neighborhoods")
def pipeline_neighborhoods(spark, d):
    """Stage 2 over the stage-1 clusters of the documents corpus."""
    s1 = pl.stage1(td.ideas(spark, d), DEFAULT_CONFIG)
    return pl.stage2(s1, DEFAULT_CONFIG).members


@query("cluster_ideas_dense")
def cluster_ideas_dense(spark, d):
    """Stage 1 with a dense per-document embedder (pandas UDF) instead of TF-IDF."""
    from ..operators.embedders import create_embedder
    return pl.stage1(td.ideas(spark, d), DEFAULT_CONFIG, create_embedder("hashing")).assignments


@query("neighborhoods_dense")
def neighborhoods_dense(spark, d):
    """Stage 2 over the dense-embedder clusters."""
    from ..operators.embedders import create_embedder
    s1 = pl.stage1(td.ideas(spark, d), DEFAULT_CONFIG, create_embedder("hashing"))
    return pl.stage2(s1, DEFAULT_CONFIG).members


@query("pipeline_neighborhoods_relational")
def pipeline_neighborhoods_relational(spark, d):
    """Stages 1-2 forced onto the relational path (as for a vocabulary too large to broadcast)."""
    cfg = DEFAULT_CONFIG.replace(centroid_broadcast_bytes=0)
    s1 = pl.stage1(td.ideas(spark, d), cfg)
    return pl.stage2(s1, cfg).members
