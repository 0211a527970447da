"""Queries: centroids, chunked and capped neighbourhoods, far pairs and cross samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import DEFAULT_CONFIG, WEEKLY_CONFIG
from ..operators import neighborhoods as nbh
from ..sources import testdata as td
from . import oracle_views as ov
from .q_cluster import SQ
from .registry import query

HASH_CFG = DEFAULT_CONFIG.replace(cross_sampling="hash")
CAP_CFG = WEEKLY_CONFIG.replace(cross_sampling="hash")


def _sql(assign_expr: str, cfg) -> str:
    """CTE chain mirroring the operator on a given clustering of the embeddings."""
    most = cfg.max_total_neighborhoods if cfg.max_total_neighborhoods is not None else 1 << 40
    pairs = cfg.max_cross_cluster_neighborhoods if cfg.max_cross_cluster_neighborhoods is not None else 1 << 40
    return f"""WITH {ov.VECTORS},
asg AS (SELECT idea_id, ({assign_expr})::INT AS cluster_id, vec FROM vec_v),
stats AS (SELECT cluster_id, count(*) AS n, min(idea_id) AS first_id,
                 row_number() OVER (ORDER BY min(idea_id)) - 1 AS ord FROM asg GROUP BY cluster_id),
cent AS (SELECT cluster_id, list(m ORDER BY i) AS cvec FROM (
           SELECT a.cluster_id, i, avg(a.vec[i]) AS m FROM asg a
           CROSS JOIN (SELECT unnest(range(1, 1 + (SELECT max(len(vec)) FROM vec_v))) AS i) GROUP BY a.cluster_id, i)
         GROUP BY cluster_id),
dist AS (SELECT a.idea_id, a.cluster_id, sqrt({SQ.format(a='a.vec', b='c.cvec')}) AS d FROM asg a JOIN cent c USING (cluster_id)),
chunks AS (SELECT cluster_id, n, ord,
                  CASE WHEN n < 3 THEN 0 WHEN n <= 30 THEN 1
                       ELSE (n + 21) // 22 - CASE WHEN n - 22 * ((n + 21) // 22 - 1) < {cfg.min_neighborhood_size}
                                                  THEN 1 ELSE 0 END END AS n_chunks FROM stats),
firsts AS (SELECT cluster_id, n, n_chunks, coalesce(sum(n_chunks) OVER (ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING
                                                                          AND 1 PRECEDING), 0) AS first_nb FROM chunks),
ranked AS (SELECT d.idea_id, d.cluster_id, f.n, f.n_chunks, f.first_nb,
                  row_number() OVER (PARTITION BY d.cluster_id
                                     ORDER BY CASE WHEN f.n <= 30 THEN 0 ELSE round(d.d, 9) END, d.idea_id) AS rnk
           FROM dist d JOIN firsts f USING (cluster_id) WHERE f.n_chunks > 0),
intra_all AS (SELECT (first_nb + least((rnk - 1) // 22, n_chunks - 1))::INT AS nb,
                     (rnk - 1 - least((rnk - 1) // 22, n_chunks - 1) * 22)::INT AS ordinal, idea_id FROM ranked),
pairs0 AS (SELECT a.cluster_id AS ca, b.cluster_id AS cb, sa.ord AS oa, sb.ord AS ob, sa.n AS na, sb.n AS nb_,
                  round(sqrt({SQ.format(a='a.cvec', b='b.cvec')}), 9) AS d
           FROM cent a JOIN stats sa ON sa.cluster_id = a.cluster_id CROSS JOIN cent b
           JOIN stats sb ON sb.cluster_id = b.cluster_id
           WHERE sa.ord < sb.ord AND least(4, sa.n, sb.n) >= 3),
pairs AS (SELECT * FROM (SELECT *, (row_number() OVER (ORDER BY d DESC, oa, ob) - 1)::INT AS p FROM pairs0)
          WHERE p < {pairs}),
tot AS (SELECT (SELECT coalesce(sum(n_chunks), 0) FROM chunks) AS intra, (SELECT count(*) FROM pairs) AS cross_n),
capp AS (SELECT intra, cross_n, {most} - cross_n AS max_intra,
                CASE WHEN intra + cross_n <= {most} THEN 0 ELSE 1 END AS capped,
                CASE WHEN {most} - cross_n > 0
                     THEN greatest(1, intra // ({most} - cross_n)) ELSE 1 END AS step FROM tot),
kept AS (SELECT i.* , CASE WHEN c.capped = 0 THEN i.nb ELSE i.nb // c.step END AS new_nb FROM intra_all i, capp c
         WHERE c.capped = 0 OR (c.max_intra > 0 AND i.nb % c.step = 0 AND i.nb // c.step < c.max_intra)),
n_kept AS (SELECT count(DISTINCT new_nb) AS k FROM kept),
sides AS (SELECT p, 0 AS side, ca AS cluster_id, least(4, na, nb_) AS n FROM pairs
          UNION ALL SELECT p, 1, cb, least(4, na, nb_) FROM pairs),
cand AS (SELECT s.p, s.side, s.n, a.idea_id,
                row_number() OVER (PARTITION BY s.p, s.side
                                   ORDER BY sha256('{cfg.cross_seed}' || '|' || s.p || '|' || s.side || '|' || a.idea_id)) AS r
         FROM sides s JOIN asg a USING (cluster_id)),
cross_m AS (SELECT ((SELECT k FROM n_kept) + p)::INT AS nb, (side * n + r - 1)::INT AS ordinal, idea_id
            FROM cand WHERE r <= n)"""


@query("centroid_distance", _sql("label", DEFAULT_CONFIG) + """
SELECT idea_id, cluster_id, round(d, 6) AS d FROM dist""")
def centroid_distance(spark, d):
    a = td.fixed_assignments(spark, d)
    cents = nbh.centroids_dense(a)
    return nbh.member_distances(a, cents).select("idea_id", "cluster_id", F.round("d", 6).alias("d"))


def _intra(spark, a, cfg):
    plan = nbh.plan_intra(nbh.cluster_sizes(a), cfg)
    return nbh.intra_members(a, plan, None).select(F.col("nb").alias("neighborhood_id"), "ordinal", "idea_id")


@query("neighborhoods_small", _sql("idea_id % 25", DEFAULT_CONFIG) + """
SELECT nb AS neighborhood_id, ordinal, idea_id FROM intra_all""")
def neighborhoods_small(spark, d):
    return _intra(spark, td.small_assignments(spark, d), DEFAULT_CONFIG)


@query("neighborhoods_chunked", _sql("label", DEFAULT_CONFIG) + """
SELECT nb AS neighborhood_id, ordinal, idea_id FROM intra_all""")
def neighborhoods_chunked(spark, d):
    return _intra(spark, td.fixed_assignments(spark, d), DEFAULT_CONFIG)


@query("cluster_pairs_far", _sql("label", DEFAULT_CONFIG) + """
SELECT p AS pair_rank, ca AS cluster_a, cb AS cluster_b, round(d, 6) AS dist FROM pairs""")
def cluster_pairs_far(spark, d):
    a = td.fixed_assignments(spark, d)
    plan = nbh.plan_intra(nbh.cluster_sizes(a), DEFAULT_CONFIG)
    pairs = nbh.far_pairs(nbh.centroids_dense(a), plan, DEFAULT_CONFIG.max_cross_cluster_neighborhoods)
    return spark.createDataFrame([(i, int(x), int(y), float(round(dd, 6))) for i, (x, y, dd) in enumerate(pairs)],
                                 "pair_rank int, cluster_a int, cluster_b int, dist double")


@query("cross_samples", _sql("label", HASH_CFG) + """
SELECT nb - (SELECT k FROM n_kept) AS pair_rank, ordinal, idea_id FROM cross_m""")
def cross_samples(spark, d):
    a = td.fixed_assignments(spark, d)
    plan = nbh.plan_intra(nbh.cluster_sizes(a), HASH_CFG)
    pairs = nbh.far_pairs(nbh.centroids_dense(a), plan, HASH_CFG.max_cross_cluster_neighborhoods)
    return nbh.cross_members(a, pairs, plan, HASH_CFG, 0).select(F.col("nb").alias("pair_rank"), "ordinal", "idea_id")


@query("neighborhoods_capped", _sql("label", CAP_CFG) + """
SELECT new_nb::INT AS neighborhood_id, 'intra' AS kind, ordinal, idea_id FROM kept
UNION ALL SELECT nb, 'cross', ordinal, idea_id FROM cross_m""")
def neighborhoods_capped(spark, d):
    return nbh.neighborhoods(td.fixed_assignments(spark, d), CAP_CFG).members


@query("neighborhood_counts", _sql("label", CAP_CFG) + """
SELECT least(intra, (SELECT k FROM n_kept) + cross_n - cross_n)::INT AS intra, cross_n::INT AS "cross",
       ((SELECT k FROM n_kept) + cross_n)::INT AS total FROM capp""")
def neighborhood_counts(spark, d):
    return nbh.neighborhoods(td.fixed_assignments(spark, d), CAP_CFG).counts


def _lcg_sql(cfg) -> str:
    """Stage 2 with the exact sequential draws: a recursive CTE advances the 32-bit LCG one draw
    per step, rejecting repeated positions, side A then side B of each accepted pair."""
    return _sql("label", cfg) + f""",
draws AS (
  WITH RECURSIVE r(p, side, s, got, fp, fs, fg) AS (
    SELECT 0, 0, {cfg.cross_seed}::BIGINT, []::BIGINT[], NULL::INT, NULL::INT, NULL::BIGINT[]
    UNION ALL
    SELECT CASE WHEN q.done AND q.side = 1 THEN q.p + 1 ELSE q.p END,
           CASE WHEN q.done THEN 1 - q.side ELSE q.side END,
           q.s2, CASE WHEN q.done THEN []::BIGINT[] ELSE q.got2 END,
           CASE WHEN q.done THEN q.p END, CASE WHEN q.done THEN q.side END, CASE WHEN q.done THEN q.got2 END
    FROM (SELECT r.p, r.side, t.s2,
                 CASE WHEN list_contains(r.got, t.idx) THEN r.got ELSE list_append(r.got, t.idx) END AS got2,
                 len(CASE WHEN list_contains(r.got, t.idx) THEN r.got ELSE list_append(r.got, t.idx) END) >= t.n AS done
          FROM r JOIN pairs pr ON pr.p = r.p,
          LATERAL (SELECT (r.s * 1664525 + 1013904223) % 4294967296 AS s2,
                          floor(((r.s * 1664525 + 1013904223) % 4294967296)::DOUBLE / 4294967295::DOUBLE
                                * (CASE WHEN r.side = 0 THEN pr.na ELSE pr.nb_ END)::DOUBLE)::BIGINT AS idx,
                          least(4, pr.na, pr.nb_) AS n) t) q)
  SELECT fp AS p, fs AS side, fg AS got FROM r WHERE fp IS NOT NULL),
picks AS (SELECT d.p, d.side, unnest(d.got) AS idx, unnest(range(len(d.got))) AS j,
                 least(4, pr.na, pr.nb_) AS n, CASE WHEN d.side = 0 THEN pr.ca ELSE pr.cb END AS cluster_id
          FROM draws d JOIN pairs pr USING (p)),
ranked_all AS (SELECT idea_id, cluster_id, row_number() OVER (PARTITION BY cluster_id ORDER BY idea_id) - 1 AS pos
               FROM asg),
cross_lcg AS (SELECT ((SELECT k FROM n_kept) + k.p)::INT AS nb, (k.side * k.n + k.j)::INT AS ordinal, ra.idea_id
              FROM picks k JOIN ranked_all ra ON ra.cluster_id = k.cluster_id AND ra.pos = k.idx)"""


@query("neighborhoods_lcg", _lcg_sql(DEFAULT_CONFIG) + """
SELECT new_nb::INT AS neighborhood_id, 'intra' AS kind, ordinal, idea_id FROM kept
UNION ALL SELECT nb, 'cross', ordinal, idea_id FROM cross_lcg""")
def neighborhoods_lcg(spark, d):
    """Stage 2 with the exact sequential cross-sample draws (default config)."""
    return nbh.neighborhoods(td.fixed_assignments(spark, d), DEFAULT_CONFIG).members
