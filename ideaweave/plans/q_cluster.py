"""Queries: k-means steps, seeding and cluster statistics."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..config import DEFAULT_CONFIG
from ..functions import vector
from ..operators import kmeans as km
from ..sources import testdata as td
from . import oracle_views as ov
from .registry import query

SQ = "list_sum(list_transform(list_zip({a}, {b}), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"


def _fixed_seeds(vectors):
    """Centroids = the vector of the smallest id per label, in label order (k x dim, k = #labels)."""
    seeds = vectors.groupBy("label").agg(F.min("idea_id").alias("idea_id"))
    rows = vectors.join(seeds, ["label", "idea_id"]).orderBy("label").select("vec").collect()
    return np.array([r[0] for r in rows], dtype=np.float64)


def _centroid_rows(spark, C):
    k, dim = C.shape
    return spark.createDataFrame([(int(c), int(j), float(round(C[c, j], 6))) for c in range(k) for j in range(dim)],
                                 "cluster_id int, dim int, value double")


def _steps_sql(steps: int) -> str:
    """CTE chain: cents0 from fixed seeds, then `steps` assign+update rounds (empty cluster -> origin)."""
    parts = [ov.VECTORS,
             "seeds AS (SELECT label, min(idea_id) AS sid FROM vec_v GROUP BY label)",
             "cents0 AS (SELECT (row_number() OVER (ORDER BY s.label) - 1)::INT AS cluster_id, v.vec AS cvec "
             "FROM seeds s JOIN vec_v v ON v.idea_id = s.sid)"]
    for s in range(steps + 1):
        parts.append(
            f"a{s} AS (SELECT idea_id, cluster_id FROM (SELECT v.idea_id, c.cluster_id, "
            f"row_number() OVER (PARTITION BY v.idea_id ORDER BY {SQ.format(a='v.vec', b='c.cvec')}, c.cluster_id) AS rn "
            f"FROM vec_v v CROSS JOIN cents{s} c) WHERE rn = 1)")
        if s < steps:
            parts.append(
                f"m{s} AS (SELECT a.cluster_id, i, avg(v.vec[i]) AS val FROM a{s} a JOIN vec_v v USING (idea_id) "
                f"CROSS JOIN (SELECT unnest(range(1, 1 + (SELECT max(len(vec)) FROM vec_v))) AS i) GROUP BY a.cluster_id, i)")
            parts.append(
                f"cents{s + 1} AS (SELECT c.cluster_id, coalesce((SELECT list(val ORDER BY i) FROM m{s} m "
                f"WHERE m.cluster_id = c.cluster_id), list_transform(c.cvec, lambda x: 0.0::DOUBLE)) AS cvec FROM cents0 c)")
    return "WITH " + ",\n".join(parts)


@query("kmeans_assign", _steps_sql(0) + "\nSELECT idea_id, cluster_id FROM a0")
def kmeans_assign(spark, d):
    v = td.vectors(spark, d)
    return km.assign_dense(v, _fixed_seeds(v)).select("idea_id", "cluster_id")


@query("kmeans_update", _steps_sql(1) + """
SELECT cluster_id, (i - 1)::INT AS dim, round(val, 6) AS value FROM m0""")
def kmeans_update(spark, d):
    v = td.vectors(spark, d)
    C0 = _fixed_seeds(v)
    counts, sums = km._lloyd_partials(v, C0, "vec")
    C1 = km.update_dense(counts, sums, C0)[counts > 0]
    keep = np.nonzero(counts > 0)[0]
    rows = [(int(c), int(j), float(round(C1[i, j], 6))) for i, c in enumerate(keep) for j in range(C1.shape[1])]
    return spark.createDataFrame(rows, "cluster_id int, dim int, value double")


@query("kmeans_two_steps", _steps_sql(2) + "\nSELECT idea_id, cluster_id FROM a2")
def kmeans_two_steps(spark, d):
    v = td.vectors(spark, d)
    C2 = km.lloyd_steps_dense(v, _fixed_seeds(v), 2)
    return km.assign_dense(v, C2).select("idea_id", "cluster_id")


def _pp_rounds() -> int:
    return 3


def _pp_sql() -> str:
    rng = km.lcg(DEFAULT_CONFIG.kmeans_seed)
    u = [next(rng) for _ in range(_pp_rounds())]
    parts = [ov.VECTORS,
             "n_v AS (SELECT count(*) AS n FROM vec_v)",
             f"s0 AS (SELECT idea_id FROM (SELECT idea_id, row_number() OVER (ORDER BY idea_id) - 1 AS pos FROM vec_v) "
             f"WHERE pos = floor({u[0]!r}::DOUBLE * (SELECT n FROM n_v)))"]
    chosen = ["s0"]
    for r in range(1, _pp_rounds()):
        dist = ", ".join(f"(SELECT {SQ.format(a='v.vec', b='w.vec')} FROM vec_v w WHERE w.idea_id = (SELECT idea_id FROM {c}))"
                         for c in chosen)
        dexpr = dist if len(chosen) == 1 else f"least({dist})"
        parts.append(f"d{r} AS (SELECT v.idea_id, {dexpr} AS d2 FROM vec_v v)")
        parts.append(f"c{r} AS (SELECT idea_id, sum(d2) OVER (ORDER BY idea_id) AS cum, sum(d2) OVER () AS tot FROM d{r})")
        parts.append(f"s{r} AS (SELECT coalesce((SELECT min(idea_id) FROM c{r} WHERE cum >= {u[r]!r}::DOUBLE * tot), "
                     f"(SELECT min(idea_id) FROM vec_v)) AS idea_id)")
        chosen.append(f"s{r}")
    sel = " UNION ALL ".join(f"SELECT {i} AS round, idea_id FROM s{i}" for i in range(_pp_rounds()))
    return "WITH " + ",\n".join(parts) + "\n" + sel


@query("kmeanspp_step", _pp_sql())
def kmeanspp_step(spark, d):
    """The first k-means++ seeds (exact sequential rule) on the embeddings."""
    v = td.vectors(spark, d)
    _, ids = km.seed_dense(v, _pp_rounds(), v.count(), DEFAULT_CONFIG.kmeans_seed, "lcg")
    return spark.createDataFrame([(i, int(x)) for i, x in enumerate(ids)], "round int, idea_id long")


@query("cluster_stats", _steps_sql(0) + """
SELECT cluster_id, count(*)::BIGINT AS n, min(idea_id) AS first_id,
       (row_number() OVER (ORDER BY min(idea_id)) - 1)::INT AS cluster_ord
FROM a0 GROUP BY cluster_id""")
def cluster_stats(spark, d):
    v = td.vectors(spark, d)
    a = km.assign_dense(v, _fixed_seeds(v)).select("idea_id", "cluster_id")
    return km.cluster_stats(a).select("cluster_id", F.col("n").cast("bigint"), "first_id", "cluster_ord")


@query("kmeans_full")
def kmeans_full(spark, d):
    """Full k-means (k-means++ seeding + Lloyd to convergence) on the dense embeddings."""
    v = td.vectors(spark, d)
    return km.kmeans_dense(v, DEFAULT_CONFIG.num_clusters).assignments


@query("cluster_ideas")
def cluster_ideas(spark, d):
    """Stage 1: TF-IDF of the ideas, then sparse k-means (every idea in exactly one cluster)."""
    from ..plans.pipeline import stage1
    return stage1(td.ideas(spark, d), DEFAULT_CONFIG).assignments


_PASSES = 12


@query("kmeans_converged", _steps_sql(_PASSES - 1) + f"\nSELECT idea_id, cluster_id FROM a{_PASSES - 1}")
def kmeans_converged(spark, d):
    """Passes from fixed centroids until no label changes (12 at most), with distance bounds."""
    v = td.vectors(spark, d)
    return km.kmeans_dense(v, 0, max_iter=_PASSES, initial=_fixed_seeds(v), bounds=True).assignments


@query("kmeans_k", """
SELECT source, count(*)::BIGINT AS n, greatest(1, least(30, count(*) // 3))::INT AS k FROM documents GROUP BY source""")
def kmeans_k(spark, d):
    """The number of clusters each source's documents would get."""
    n = td.ideas(spark, d).groupBy("source").agg(F.count(F.lit(1)).cast("bigint").alias("n"))
    return n.withColumn("k", km.effective_k_column("n", DEFAULT_CONFIG.num_clusters))


@query("dot_product", f"""WITH {ov.VECTORS}, s AS (SELECT label, arg_min(vec, idea_id) AS v0 FROM vec_v GROUP BY label)
SELECT idea_id, round(list_dot_product(vec, v0), 6) AS dot FROM vec_v JOIN s USING (label)""")
def dot_product(spark, d):
    """Similarity of each unit vector to the first one of its label."""
    v = td.vectors(spark, d)
    first = v.groupBy("label").agg(F.min_by("vec", "idea_id").alias("v0"))  # one row per label
    return v.join(F.broadcast(first), "label").select("idea_id", F.round(vector.dot("vec", "v0"), 6).alias("dot"))
