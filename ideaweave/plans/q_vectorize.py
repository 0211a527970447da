"""Queries: idea loading, tokenising and TF-IDF (A2, C1, C2, D-1..D-9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import embed_document
from ..operators import ingest, tfidf as tf
from ..sources import testdata as td
from . import oracle_views as ov
from .registry import query


@query("load_ideas", f"""
WITH {ov.IDEAS}
SELECT idea_id, title, source, url, category,
       coalesce(title, '') || ' ' || coalesce(category, '') || ' ' || coalesce(description, '') AS doc
FROM ideas_v WHERE description <> '' OR title <> ''
""")
def load_ideas(spark, d):
    ideas = ingest.loadable(td.ideas(spark, d))
    return ideas.select("idea_id", "title", "source", "url", "category", embed_document().alias("doc"))


@query("tokens", f"""
WITH {ov.TOKENS}
SELECT idea_id, len(tokens)::BIGINT AS n_tokens, array_to_string(tokens, ' ') AS token_text FROM tok_v
""")
def tokens(spark, d):
    t = tf.tokens(tf.documents(td.ideas(spark, d)))
    return t.select("idea_id", F.size("tokens").cast("bigint").alias("n_tokens"),
                    F.array_join("tokens", " ").alias("token_text"))


@query("doc_lengths", f"""
WITH {ov.TOKENS}
SELECT idea_id, len(tokens)::BIGINT AS n_tokens, len(list_distinct(tokens))::BIGINT AS n_distinct FROM tok_v
""")
def doc_lengths(spark, d):
    t = tf.tokens(tf.documents(td.ideas(spark, d)))
    return t.select("idea_id", F.size("tokens").cast("bigint").alias("n_tokens"),
                    F.size(F.array_distinct("tokens")).cast("bigint").alias("n_distinct"))


@query("term_df", f"""
WITH {ov.TOKENS}
SELECT term, df::BIGINT AS df FROM df_v
""")
def term_df(spark, d):
    t = tf.tokens(tf.documents(td.ideas(spark, d)))
    return tf.document_frequencies(tf.term_frequencies(t)).select("term", F.col("df").cast("bigint"))


@query("vocabulary", f"""
WITH {ov.TOKENS}
SELECT term, df::BIGINT AS df, round(idf, 6) AS idf FROM vocab_v
""")
def vocabulary(spark, d):
    v = tf.tfidf(td.ideas(spark, d)).vocab
    return v.select("term", F.col("df").cast("bigint"), F.round("idf", 6).alias("idf"))


@query("vocab_size", f"""
WITH {ov.TOKENS}
SELECT (SELECT count(*) FROM documents)::BIGINT AS n_docs,
       (SELECT count(*) FROM vocab_v)::BIGINT AS dimensions,
       (SELECT count(*) FROM weights_v)::BIGINT AS nnz
""")
def vocab_size(spark, d):
    v = tf.tfidf(td.ideas(spark, d))
    # three scalars (counts) assembled into one row
    return spark.createDataFrame([(v.n_docs, v.vocab.count(), v.weights.count())],
                                 "n_docs bigint, dimensions bigint, nnz bigint")


@query("tfidf_weights", f"""
WITH {ov.TOKENS}
SELECT idea_id, term, round(weight, 6) AS weight FROM weights_v
""")
def tfidf_weights(spark, d):
    w = tf.tfidf(td.ideas(spark, d)).weights
    return w.select("idea_id", "term", F.round("weight", 6).alias("weight"))


@query("tfidf_norms", f"""
WITH {ov.TOKENS}
SELECT t.idea_id, t.n_tokens::BIGINT AS n_tokens, count(w.term)::BIGINT AS nnz,
       round(coalesce(sum(w.weight * w.weight), 0.0), 6) AS norm2
FROM (SELECT idea_id, len(tokens) AS n_tokens FROM tok_v) t LEFT JOIN weights_v w USING (idea_id)
GROUP BY t.idea_id, t.n_tokens
""")
def tfidf_norms(spark, d):
    """L2 norm per document incl. zero vectors (documents with no vocabulary term)."""
    v = tf.tfidf(td.ideas(spark, d))
    per = v.weights.groupBy("idea_id").agg(F.count(F.lit(1)).alias("nnz"),
                                           F.sum(F.col("weight") * F.col("weight")).alias("norm2"))
    return (v.docs.join(per, "idea_id", "left")
            .select("idea_id", F.col("n_tokens").cast("bigint"),
                    F.coalesce("nnz", F.lit(0)).cast("bigint").alias("nnz"),
                    F.round(F.coalesce("norm2", F.lit(0.0)), 6).alias("norm2")))


def _earlier(ideas):
    """An earlier state of the ideas: every second one, every third of them with another text, and two that are gone."""
    was = ideas.where("idea_id % 2 = 0").withColumn("description", F.when(F.col("idea_id") % 3 == 0, F.reverse("description"))
                                                      .otherwise(F.col("description")))
    return was.unionByName(ideas.where("idea_id < 2").withColumn("idea_id", F.col("idea_id") - 1000))


@query("tfidf_refresh", f"""
WITH {ov.TOKENS}
SELECT idea_id, term, round(weight, 6) AS weight FROM weights_v
""")
def tfidf_refresh(spark, d):
    """Weights after new, changed and removed ideas, from the kept counts of an earlier state."""
    from ..operators.store import SnapshotStore
    from ..streaming.jobs import scratch
    ideas, st = td.ideas(spark, d), SnapshotStore(spark, scratch(spark, "tfidf"))
    tf.refresh(st, _earlier(ideas))
    return tf.refresh(st, ideas)[0].weights.select("idea_id", "term", F.round("weight", 6).alias("weight"))


@query("embedding_job", f"""
WITH {ov.TOKENS},
was AS (SELECT idea_id, CASE WHEN idea_id % 3 = 0 THEN reverse(description) ELSE description END AS description FROM ideas_v
        WHERE idea_id % 2 = 0)
SELECT 'tfidf_v1' AS model, (SELECT count(*) FROM ideas_v)::BIGINT AS documents,
       (SELECT count(*) FROM ideas_v i LEFT JOIN was w USING (idea_id)
        WHERE w.idea_id IS NULL OR w.description IS DISTINCT FROM i.description)::BIGINT
         + (SELECT count(*) FROM ideas_v WHERE idea_id < 2)::BIGINT AS read,
       (SELECT count(*) FROM vocab_v)::BIGINT AS dimensions
""")
def embedding_job(spark, d):
    """The embedding job on kept counts: texts read are the new and changed ones (and those taken out)."""
    from ..operators.store import SnapshotStore
    from ..streaming.jobs import scratch
    from . import pipeline
    ideas, st = td.ideas(spark, d), SnapshotStore(spark, scratch(spark, "embed"))
    pipeline.embedding_job(_earlier(ideas), store=st)
    return pipeline.embedding_job(ideas, store=st)
