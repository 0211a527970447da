"""Neighbourhood formation (F1-F11): bounded groups inside and across clusters.

Rules reproduced:
  * clusters are visited in order of their first (smallest) member id;
  * a cluster of 3..30 members is one neighbourhood (members in id order); smaller ones
    are dropped; a larger one is sorted by distance to its centroid (ties by id) and cut
    into chunks of 22, a last chunk below ``min_neighborhood_size`` joining the previous;
  * cross neighbourhoods: all cluster pairs by centroid distance, farthest first, pairs
    whose smaller side has < 3 members skipped, at most ``max_cross`` taken; each takes
    min(4, |A|, |B|) members of each side sampled without replacement;
  * cap: if intra + cross > max_total, keep every cross one and intra ones with stride
    floor(intra / (max_total - cross)), at most max_total - cross of them.

Distribution: the plan is one row per cluster (first neighbourhood id, number of chunks). A row's
neighbourhood follows from its rank by arithmetic, and so does the cap (a stride and a count), so no
list of chunks exists anywhere. Rows are only ranked for clusters that keep a neighbourhood; ranks
inside a cluster come from a range-partitioned numbering, so a cluster holding a third of all rows
still spreads over many tasks. Sampled positions are found by counting ids in buckets, without a
sort (``ranking.at_positions``). Long form output: ``(neighborhood_id, kind, ordinal, idea_id)``.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import (CHUNK_SIZE, CROSS_SAMPLE_PER_SIDE, DEFAULT_CONFIG, MIN_CLUSTER_SIZE, SMALL_CLUSTER_MAX,
                      PipelineConfig)
from ..functions.vector import dist as vdist
from .kmeans import lcg
from .ranking import at_positions, rank_within  # noqa: F401  (rank_within is re-exported)

NB_SCHEMA = "neighborhood_id int, kind string, ordinal int, idea_id long"


# ---------------------------------------------------------------------------
# centroids and distances (dense vectors)
# ---------------------------------------------------------------------------

def centroids_dense(members: DataFrame, vec_col: str = "vec") -> DataFrame:
    """(cluster_id, centroid array<double>, n) -- per-dimension means with map-side partial sums."""
    ex = members.select("cluster_id", F.posexplode(vec_col).alias("pos", "x"))
    per = ex.groupBy("cluster_id", "pos").agg(F.sum("x").alias("s"), F.count(F.lit(1)).alias("n"))
    return (per.groupBy("cluster_id")
            .agg(F.array_sort(F.collect_list(F.struct("pos", (F.col("s") / F.col("n")).alias("m")))).alias("ms"),
                 F.max("n").alias("n"))
            .select("cluster_id", F.transform("ms", lambda x: x["m"]).alias("centroid"), "n"))


def member_distances(members: DataFrame, cents: DataFrame, vec_col: str = "vec") -> DataFrame:
    """(idea_id, cluster_id, d) Euclidean distance to the own centroid; k centroid rows are broadcast."""
    return (members.join(F.broadcast(cents.select("cluster_id", "centroid")), "cluster_id")
            .select("idea_id", "cluster_id", vdist(vec_col, "centroid").alias("d")))


# ---------------------------------------------------------------------------
# driver-side planning from cluster sizes
# ---------------------------------------------------------------------------

class Plan(NamedTuple):
    order: list  # cluster ids in visiting order
    sizes: dict
    chunks: dict  # cluster -> number of intra neighbourhoods
    first_nb: dict  # cluster -> id of its first intra neighbourhood
    intra_total: int


def chunk_count(size: int, min_size: int) -> int:
    if size < MIN_CLUSTER_SIZE:
        return 0
    if size <= SMALL_CLUSTER_MAX:
        return 1
    m = math.ceil(size / CHUNK_SIZE)
    last = size - CHUNK_SIZE * (m - 1)
    return m - 1 if (m > 1 and last < min_size) else m


def plan_intra(stats: list, cfg: PipelineConfig) -> Plan:
    """stats: (cluster_id, n, first_id) rows -- k of them."""
    order = [c for c, _, _ in sorted(stats, key=lambda r: r[2])]
    sizes = {c: n for c, n, _ in stats}
    chunks, first, acc = {}, {}, 0
    for c in order:
        chunks[c] = chunk_count(sizes[c], cfg.min_neighborhood_size)
        first[c] = acc
        acc += chunks[c]
    return Plan(order, sizes, chunks, first, acc)


class Cap(NamedTuple):
    """Kept intra neighbourhoods: every ``step``-th, the first ``count`` of them."""
    step: int
    count: int


def cap_rule(intra: int, cross: int, max_total: int | None) -> Cap:
    """The total cap as arithmetic: neighbourhood ``nb`` is kept as ``nb // step`` if that divides and is below ``count``."""
    if max_total is None or intra + cross <= max_total:
        return Cap(1, intra)
    room = max_total - cross
    if room <= 0:
        return Cap(1, 0)
    step = max(1, intra // room)
    return Cap(step, min(room, -(-intra // step)))


def cap_plan(intra: int, cross: int, max_total: int | None):
    """Kept intra positions under the total cap, written out (small inputs)."""
    cap = cap_rule(intra, cross, max_total)
    return [i * cap.step for i in range(cap.count)]


def lcg_cross_draws(pairs: list, sizes: dict, seed: int):
    """Exact draw sequence: for each accepted pair, member positions (0-based, id order) per side."""
    rng = lcg(seed)

    def distinct(n: int, size: int) -> list:
        seen: dict[int, None] = {}  # keeps the order in which positions first come up
        while len(seen) < n:
            seen.setdefault(math.floor(next(rng) * size))
        return list(seen)

    return [[(side, c, distinct(min(CROSS_SAMPLE_PER_SIDE, sizes[a], sizes[b]), sizes[c]))
             for side, c in zip("ab", (a, b))] for a, b in pairs]


# ---------------------------------------------------------------------------
# the operator
# ---------------------------------------------------------------------------

class Neighborhoods(NamedTuple):
    members: DataFrame  # neighborhood_id, kind, ordinal, idea_id
    counts: DataFrame  # intra, cross, total (one row)
    intra_count: int
    cross_count: int
    total: int


def cluster_sizes(assign: DataFrame) -> list:
    return [(r[0], r[1], r[2]) for r in
            assign.groupBy("cluster_id").agg(F.count(F.lit(1)), F.min("idea_id")).collect()]


def keeps_any(first: int, chunks: int, cap: Cap) -> bool:
    """Whether one of the neighbourhoods ``first .. first + chunks - 1`` is kept."""
    m = -(-first // cap.step)
    return m < cap.count and m * cap.step < first + chunks


def intra_members(assign_vec: DataFrame, plan: Plan, cap: Cap | None = None, vec_col: str = "vec",
                  distances: DataFrame | None = None) -> DataFrame:
    """Intra neighbourhood rows ``(nb, ordinal, idea_id)`` with their ids after the cap.

    Only clusters with a kept neighbourhood are ranked. The broadcast side has one row per cluster.
    """
    spark = assign_vec.sparkSession
    cap = cap or Cap(1, plan.intra_total)
    meta = [(int(c), int(plan.first_nb[c]), int(plan.chunks[c]), plan.sizes[c] > SMALL_CLUSTER_MAX)
            for c in plan.order if plan.chunks[c] and keeps_any(plan.first_nb[c], plan.chunks[c], cap)]
    if not meta:
        return spark.createDataFrame([], "nb int, ordinal int, idea_id long")
    table = F.broadcast(spark.createDataFrame(meta, "cluster_id int, first_nb long, n_chunks long, large boolean"))
    if any(m[3] for m in meta):
        if distances is None:
            distances = member_distances(assign_vec, centroids_dense(assign_vec, vec_col), vec_col)
        rows = distances.select("idea_id", "cluster_id", F.round("d", 9).alias("d9"))
    else:
        rows = assign_vec.select("idea_id", "cluster_id", F.lit(0.0).alias("d9"))
    # members of small clusters are in id order, those of large ones by distance
    rows = rows.join(table, "cluster_id").withColumn("d9", F.when(F.col("large"), F.col("d9")).otherwise(F.lit(0.0)))
    r = rank_within(rows, "cluster_id", ["d9", "idea_id"])
    chunk = F.when(F.col("large"), F.least(F.floor((F.col("rank") - 1) / CHUNK_SIZE), F.col("n_chunks") - 1)).otherwise(F.lit(0))
    nb = F.col("first_nb") + F.col("chunk")
    r = r.withColumn("chunk", chunk.cast("long")).withColumn("nb", nb)
    if cap.step > 1:
        r = r.where(F.col("nb") % F.lit(cap.step) == 0).withColumn("nb", F.floor(F.col("nb") / F.lit(cap.step)))
    return r.where(F.col("nb") < F.lit(cap.count)).select(
        F.col("nb").cast("int").alias("nb"), (F.col("rank") - 1 - F.col("chunk") * CHUNK_SIZE).cast("int").alias("ordinal"), "idea_id")


def pair_table(plan: Plan, spark: SparkSession) -> DataFrame:
    """(cluster_id, ord, size) for the k clusters."""
    return spark.createDataFrame([(int(c), i, int(plan.sizes[c])) for i, c in enumerate(plan.order)],
                                 "cluster_id int, ord int, size long")


def top_pairs(pairs: DataFrame, max_cross: int | None) -> list:
    """Top ``max_cross`` (None: all) eligible pairs from ``(ca, cb, oa, ob, na, nb, d)`` (oa < ob).

    The eligibility filter runs before the top-n, so skipped pairs never use the limit; the
    sort is a TakeOrdered over at most k^2/2 rows.
    """
    top = (pairs.where(F.least(F.lit(CROSS_SAMPLE_PER_SIDE), "na", "nb") >= MIN_CLUSTER_SIZE)
           .orderBy(F.desc("d"), "oa", "ob"))
    top = top if max_cross is None else top.limit(max_cross)
    return [(r["ca"], r["cb"], r["d"]) for r in top.collect()]


def far_pairs(cents: DataFrame, plan: Plan, max_cross: int | None) -> list:
    """Farthest eligible cluster pairs for dense centroids (a theta self-join over k rows)."""
    c = cents.join(pair_table(plan, cents.sparkSession), "cluster_id")
    a = c.select(F.col("cluster_id").alias("ca"), F.col("ord").alias("oa"), F.col("size").alias("na"),
                 F.col("centroid").alias("va"))
    b = c.select(F.col("cluster_id").alias("cb"), F.col("ord").alias("ob"), F.col("size").alias("nb"),
                 F.col("centroid").alias("vb"))
    pairs = (a.join(F.broadcast(b), F.col("oa") < F.col("ob"))
             .select("ca", "cb", "oa", "ob", "na", "nb", F.round(vdist("va", "vb"), 9).alias("d")))
    return top_pairs(pairs, max_cross)


def gram_pairs(gram, plan: Plan, spark: SparkSession) -> DataFrame:
    """Pair distances from a k x k Gram matrix of the centroids: d^2 = G_aa + G_bb - 2 G_ab."""
    g = np.asarray(gram)
    return distance_pairs(np.sqrt(np.maximum(g.diagonal()[:, None] + g.diagonal()[None, :] - 2 * g, 0.0)), plan, spark)


def distance_pairs(gaps, plan: Plan, spark: SparkSession) -> DataFrame:
    """Pair distances from the k x k distances of the centroids."""
    order = np.array(plan.order)
    size = np.array([plan.sizes[c] for c in plan.order])
    d = np.asarray(gaps)[np.ix_(order, order)].round(9)
    i, j = np.triu_indices(len(order), 1)
    return spark.createDataFrame(pd.DataFrame({"ca": order[i], "cb": order[j], "oa": i, "ob": j, "na": size[i], "nb": size[j], "d": d[i, j]}),
                                 "ca int, cb int, oa int, ob int, na long, nb long, d double")


def cross_members(assign: DataFrame, pairs: list, plan: Plan, cfg: PipelineConfig, first_id: int) -> DataFrame:
    """Rows ``(nb, ordinal, idea_id)`` of the cross neighbourhoods ``first_id, first_id+1, ...``."""
    spark = assign.sparkSession
    if not pairs:
        return spark.createDataFrame([], "nb int, ordinal int, idea_id long")
    if cfg.cross_sampling == "lcg":
        draws = lcg_cross_draws([(a, b) for a, b, _ in pairs], plan.sizes, cfg.cross_seed)
        rows = []
        for p, picks in enumerate(draws):
            o = 0
            for side, c, got in picks:
                for idx in got:
                    rows.append((first_id + p, o, int(c), idx + 1))
                    o += 1
        return at_positions(assign.select("idea_id", "cluster_id"), "cluster_id", rows, "nb int, ordinal int, cluster_id int, rank long")
    # hash sampling: per (pair, side) the n members with the smallest SHA-256 of (seed|pair|side|id)
    sides = spark.createDataFrame(
        [(first_id + p, s, int(c), int(min(CROSS_SAMPLE_PER_SIDE, plan.sizes[a], plan.sizes[b])), p)
         for p, (a, b, _) in enumerate(pairs) for s, c in ((0, a), (1, b))],
        "nb int, side int, cluster_id int, n int, pair int")
    cand = (assign.select("idea_id", "cluster_id")
            .join(F.broadcast(sides), "cluster_id")
            .withColumn("h", F.sha2(F.concat_ws("|", F.lit(str(cfg.cross_seed)), F.col("pair").cast("string"),
                                                F.col("side").cast("string"), F.col("idea_id").cast("string")), 256)))
    from pyspark.sql import Window
    w = Window.partitionBy("nb", "side").orderBy("h")
    # literal bound first so Spark applies a partial per-task group limit before the shuffle
    top = (cand.withColumn("r", F.row_number().over(w)).where(F.col("r") <= CROSS_SAMPLE_PER_SIDE)
           .where(F.col("r") <= F.col("n")))
    return top.select("nb", ((F.col("side") * F.col("n")) + F.col("r") - 1).cast("int").alias("ordinal"), "idea_id")


def neighborhoods(assign_vec: DataFrame, cfg: PipelineConfig = DEFAULT_CONFIG, vec_col: str = "vec",
                  cents: DataFrame | None = None, distances: DataFrame | None = None,
                  pair_fn=None) -> Neighborhoods:
    """Stage 2 over ``(idea_id, cluster_id, vec)``; returns long-form members and counts.

    ``distances`` (member -> own centroid) and ``pair_fn(plan) -> pair DataFrame`` let other
    vector layouts (sparse) supply their own geometry.
    """
    spark = assign_vec.sparkSession
    plan = plan_intra(cluster_sizes(assign_vec), cfg)
    if pair_fn is not None:
        pairs = top_pairs(pair_fn(plan), cfg.max_cross_cluster_neighborhoods)
    else:
        if cents is None:
            cents = centroids_dense(assign_vec, vec_col)
        pairs = far_pairs(cents, plan, cfg.max_cross_cluster_neighborhoods)
    n_cross = len(pairs)
    cap = cap_rule(plan.intra_total, n_cross, cfg.max_total_neighborhoods)
    intra = (intra_members(assign_vec, plan, cap, vec_col, distances)
             .select(F.col("nb").alias("neighborhood_id"), F.lit("intra").alias("kind"), "ordinal", "idea_id"))
    cross = cross_members(assign_vec.select("idea_id", "cluster_id"), pairs, plan, cfg, cap.count) \
        .select(F.col("nb").alias("neighborhood_id"), F.lit("cross").alias("kind"), "ordinal", "idea_id")
    total = cap.count + n_cross
    intra_rep = min(plan.intra_total, total - n_cross)
    counts = spark.createDataFrame([(intra_rep, n_cross, total)], "intra int, cross int, total int")
    return Neighborhoods(intra.unionByName(cross), counts, intra_rep, n_cross, total)
