"""The whole run as a composition of DataFrame operators (stages 1-4 + result bundle).

    ideas -> [1] TF-IDF + k-means -> assignments
          -> [2] neighbourhoods (bounded groups) -> [3] discovery prompts -> responder -> constellations
          -> [4] cluster theme prompts -> responder -> patterns
          -> ledger, metadata, JSON / Parquet sinks

Stages 3 and 4 only read stage 1-2 outputs, so they are independent Spark jobs. The driver
only ever holds k-sized values (sizes, centroids within the broadcast bound, counters).
"""

from __future__ import annotations

import time
from typing import Callable, NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import (DEFAULT_CONFIG, DISCOVERY_PROMPT_VERSION, PATTERNS_PROMPT_VERSION, PipelineConfig)
from ..operators import blocks as bl
from ..operators import discovery as disc
from ..operators import ingest, kmeans as km, ledger as led, neighborhoods as nbh, report, store as st
from ..operators import tfidf as tf
from ..operators.embedders import DenseVectors
from ..session import cut_lineage


PATTERN_KEY = ["cluster_hash", "pattern_title", "prompt_version"]


class Stage1(NamedTuple):
    assignments: DataFrame  # idea_id, cluster_id
    vectors: tf.Vectors
    k: int
    iterations: int
    centroids: object  # k x dim matrix or ``Sliced`` (within the broadcast bound), else centroid-term table (relational path)
    rows: DataFrame | None  # CSR rows (idea_id, idx, w) when the centroids fit in a matrix
    dense: DataFrame | None = None  # (idea_id, vec) when a dense embedder was used
    reused: bool = False  # vectors came from the embedding cache
    fit: km.SparseFit | None = None  # sparse rows: blocks, centroids in slices, sums of the labels


def cached_tfidf(ideas: DataFrame, cfg: PipelineConfig, store: st.SnapshotStore | None, force: bool = False):
    """TF-IDF vectors; with a store, only texts that are new or changed since the last run are read again
    (``tfidf.refresh``). Returns (vectors, reused); ``reused`` is true when no text had to be read."""
    if store is None:
        return tf.tfidf(ideas, cfg), False
    vecs, n_changed = tf.refresh(store, ideas, cfg, force)
    return vecs, n_changed == 0


def cached_dense(ideas: DataFrame, embedder, store: st.SnapshotStore | None, force: bool = False):
    """Vectors of a per-document embedder: only ideas without a stored vector of its model, or with
    another text than the stored one's, are embedded.

    New vectors are appended (merged on read, by idea and model) and read back, so each is computed
    once. Returns (vectors, reused); ``reused`` is true when nothing had to be embedded.
    """
    if store is None:
        return embedder.fit_transform(ideas), False
    key = ["idea_id", "model"]
    texts = tf.documents(ideas).select("idea_id", F.xxhash64("doc").alias("text_hash"))
    held = store.merged("embeddings", key)
    todo = ideas
    if held is not None and not force:
        done = held.where(F.col("model") == embedder.model).select("idea_id", "text_hash")
        todo = ideas.join(texts.join(done, ["idea_id", "text_hash"], "left_semi"), "idea_id", "left_anti")
    reused = todo.isEmpty()
    if not reused:
        fresh = cut_lineage(embedder.fit_transform(todo).vectors.join(texts, "idea_id").withColumns(
            {"model": F.lit(embedder.model), "created_at": F.current_timestamp()}))
        store.upsert("embeddings", fresh, key, partition_by=["model"])
        held = store.merged("embeddings", key)
    elif held is None:  # no ideas and nothing stored
        return embedder.fit_transform(ideas), False
    mine = held.where(F.col("model") == embedder.model).select("idea_id", "vec")
    return DenseVectors(mine.join(ideas.select("idea_id"), "idea_id", "left_semi"), embedder.dimensions,
                        embedder.model), reused


def embedding_job(ideas: DataFrame, cfg: PipelineConfig = DEFAULT_CONFIG, embedder=None,
                  store: st.SnapshotStore | None = None, force: bool = False) -> DataFrame:
    """The embedding stage alone: brings the stored vectors of the loadable ideas up to date.

    One row ``(model, documents, read, dimensions)``; ``read``: texts that were new or changed.
    """
    spark, ideas = ideas.sparkSession, ingest.loadable(ideas)
    if embedder is None:
        if store is None:
            vecs, read = tf.tfidf(ideas, cfg), None
        else:
            vecs, read = tf.refresh(store, ideas, cfg, force)
        n, model, dim = vecs.n_docs, vecs.model, vecs.vocab.count()
    else:
        before = None if store is None or force else store.merged("embeddings", ["idea_id", "model"])
        had = 0 if before is None else before.where(F.col("model") == embedder.model).join(
            tf.documents(ideas).select("idea_id", F.xxhash64("doc").alias("text_hash")), ["idea_id", "text_hash"], "left_semi").count()
        vecs, _ = cached_dense(ideas, embedder, store, force)
        n, model, dim = vecs.vectors.count(), embedder.model, embedder.dimensions
        read = n - had
    return spark.createDataFrame([(model, int(n), int(n if read is None else read), int(dim))],
                                 "model string, documents bigint, read bigint, dimensions bigint")


def stage1(ideas: DataFrame, cfg: PipelineConfig = DEFAULT_CONFIG, embedder=None,
           store: st.SnapshotStore | None = None, force: bool = False) -> Stage1:
    """Embed the loadable ideas (TF-IDF by default, cached in ``store``) and cluster them with k-means."""
    ideas = ingest.loadable(ideas)
    reused = False
    if embedder is None:
        vecs, reused = cached_tfidf(ideas, cfg, store, force)
    elif hasattr(embedder, "dimensions"):
        vecs, reused = cached_dense(ideas, embedder, store, force)
    else:
        vecs = embedder.fit_transform(ideas)
    if isinstance(vecs, DenseVectors):
        dense = cut_lineage(vecs.vectors)
        res = km.kmeans_dense(dense, cfg.num_clusters, cfg.kmeans_max_iter, cfg.kmeans_seed, cfg.kmeans_init,
                              cfg.kmeans_empty)
        return Stage1(cut_lineage(res.assignments), vecs, res.k, res.iterations, res.centroids, None, dense,
                      reused)
    n = vecs.n_docs
    k = km.effective_k(n, cfg.num_clusters)
    dim = vecs.vocab.count() if vecs.numbered is None else vecs.numbered.size
    small = k * max(dim, 1) * 8 <= min(cfg.centroid_broadcast_bytes, km.MAX_BROADCAST_CENTROID_BYTES)
    if small and not (cfg.kmeans_init == "lcg" and k < min(n, km.BOUNDS_K)):
        rows, dim = km.csr_rows(vecs.weights, vecs.docs, vecs.vocab)
        rows = cut_lineage(rows)
        res = km.kmeans_dense(rows, cfg.num_clusters, cfg.kmeans_max_iter, cfg.kmeans_seed, cfg.kmeans_init,
                              cfg.kmeans_empty, ("idx", "w"), n=n, dim=dim)
        return Stage1(cut_lineage(res.assignments), vecs, res.k, res.iterations, res.centroids, rows,
                      reused=reused, fit=res.fit)
    res = km.kmeans_sparse(vecs.weights, vecs.docs, cfg.num_clusters, cfg.kmeans_max_iter, cfg.kmeans_seed,
                           cfg.kmeans_init, cfg.kmeans_empty, max(dim, cfg.broadcast_max_rows) if small else cfg.broadcast_max_rows,
                           cfg.salt_buckets, n=n, vocab=vecs.vocab, as_matrix=small, counts=vecs.counts, numbered=vecs.numbered)
    rows = bl.unpack(res.fit.packed.blocks, res.fit.packed.idf) if small and res.fit else None
    return Stage1(res.assignments, vecs, res.k, res.iterations, res.centroids, rows, reused=reused, fit=res.fit)


def _member_distance(rows: DataFrame, assign: DataFrame, C: np.ndarray) -> DataFrame:
    """(idea_id, cluster_id, d): distance of each member to its own cluster's mean (CSR rows)."""
    bc = rows.sparkSession.sparkContext.broadcast((np.asarray(C, dtype=np.float64), bl.squares(C)))

    def fn(batches):
        Cm, c2 = bc.value
        for b in batches:
            label = b.column(1).to_numpy()
            idx, off = bl._lists(b.column(2))
            w = bl._lists(b.column(3))[0]
            x = bl.Rows(b.column(0).to_numpy(), off, idx, w, True)
            own = np.rint(w * Cm[np.repeat(label, np.diff(off)), idx] * bl.PRODUCT_STEP).astype(np.int64)
            total = np.concatenate([[0], np.cumsum(own)])
            steps = x.x2() - 2 * (total[off[1:]] - total[off[:-1]]) + c2[label]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(np.sqrt(np.maximum(steps, 0) / bl.PRODUCT_STEP))],
                                             names=["idea_id", "cluster_id", "d"])

    return rows.join(assign, "idea_id").select("idea_id", "cluster_id", "idx", "w") \
        .mapInArrow(fn, "idea_id long, cluster_id int, d double")


def stage2(s1: Stage1, cfg: PipelineConfig = DEFAULT_CONFIG) -> nbh.Neighborhoods:
    """Neighbourhoods over the stage-1 clusters (centroids = means of the final members)."""
    spark = s1.assignments.sparkSession
    if s1.dense is not None:
        return nbh.neighborhoods(s1.assignments.join(s1.dense, "idea_id"), cfg)
    if s1.fit is not None:
        # sums and counts of the last pass are those of the final members
        dist, gaps = km.member_distances(s1.fit)
        return nbh.neighborhoods(s1.assignments, cfg, distances=dist,
                                 pair_fn=lambda plan: nbh.distance_pairs(gaps, plan, spark))
    if s1.rows is None:
        return _stage2_relational(s1, cfg)
    counts, sums = km._lloyd_partials(s1.rows, s1.centroids, ("idx", "w"))
    means = np.zeros_like(sums)
    nz = counts > 0
    means[nz] = sums[nz] / counts[nz][:, None]
    # k rows; each centroid is within the broadcast bound already checked in stage 1
    cents = spark.createDataFrame([(int(c), means[c].tolist(), int(counts[c])) for c in np.flatnonzero(nz)],
                                  "cluster_id int, centroid array<double>, n long")
    dist = _member_distance(s1.rows, s1.assignments, means)
    return nbh.neighborhoods(s1.assignments, cfg, cents=cents, distances=dist)


def _stage2_relational(s1: Stage1, cfg: PipelineConfig) -> nbh.Neighborhoods:
    """Stage 2 when the centroid matrix is too large to broadcast: everything stays long-form.

    Centroids are a ``(cluster, term, cw)`` table; member distances join each member's weights
    with its own cluster's centroid terms (a hot term is spread by the salted join); pair
    distances come from the per-partition Gram matrix.
    """
    spark = s1.assignments.sparkSession
    W = s1.vectors.weights
    cent, sizes = km.centroids_sparse(W, s1.assignments)
    cent = cut_lineage(cent)
    k = max(sizes) + 1 if sizes else 0
    c2 = km._c2(cent, k)
    c2_map = F.create_map(*[x for c, v in c2.items() for x in (F.lit(int(c)), F.lit(int(v)).cast("long"))])
    # sums over integers, as on the matrix path: equal members get equal distances on both
    n_rows = cent.count()
    if n_rows <= cfg.broadcast_max_rows:
        own = W.join(s1.assignments, "idea_id").join(F.broadcast(cent), ["cluster_id", "term"], "left")
    else:  # a term common in a hot cluster is dealt out by idea
        salt = F.pmod(F.xxhash64("idea_id"), F.lit(cfg.salt_buckets)).cast("int")
        many = cent.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(cfg.salt_buckets - 1))))
        own = W.join(s1.assignments, "idea_id").withColumn("_s", salt).join(many, ["cluster_id", "term", "_s"], "left")
    per = own.groupBy("idea_id").agg(
        F.sum(km._steps(F.col("weight") * F.col("weight"), bl.PRODUCT_STEP)).alias("x2"),
        F.sum(km._steps(F.coalesce(F.col("weight") * F.col("cw"), F.lit(0.0)), bl.PRODUCT_STEP)).alias("dot"))
    zero = F.lit(0).cast("long")
    steps = F.coalesce("x2", zero) - 2 * F.coalesce("dot", zero) + F.element_at(c2_map, F.col("cluster_id"))
    dist = (s1.assignments.join(per, "idea_id", "left")
            .select("idea_id", "cluster_id", F.sqrt(F.greatest(zero, steps).cast("double") / F.lit(bl.PRODUCT_STEP)).alias("d")))
    G = km.centroid_gram(cent, k)
    return nbh.neighborhoods(s1.assignments, cfg, distances=dist,
                             pair_fn=lambda plan: nbh.gram_pairs(G, plan, spark))


class Result(NamedTuple):
    constellations: DataFrame
    patterns: DataFrame
    ideas: DataFrame
    metadata: DataFrame
    responses: DataFrame
    neighborhoods: DataFrame


def _reply_log(store: st.SnapshotStore | None, table: str) -> disc.ReplyLog | None:
    """The log of the run that is about to write the next part of ``table``: a run that died finds its replies."""
    return None if store is None else disc.ReplyLog(f"{store.root}/replies/{table}", f"run {store.next_part(table)}")


def stage3(members: DataFrame, ideas: DataFrame, responder: Callable, cfg: PipelineConfig,
           store: st.SnapshotStore | None = None, force: bool = False):
    """Discovery over neighbourhoods with the constellation cache.

    The cache is append-only and tagged with ``run_id``; hits read the latest run per
    (hash, prompt version), so a forced re-run adds a run instead of duplicating rows.
    """
    prompts = disc.neighborhood_prompts(members, ideas)
    stored = store.read_parts("constellations") if store is not None else None
    cached = None if stored is None else st.latest_run(
        stored.where(F.col("prompt_version") == DISCOVERY_PROMPT_VERSION), ["neighborhood_hash", "prompt_version"])
    if cached is not None and not force:
        keys = cached.select(F.col("neighborhood_hash").alias("group_hash")).distinct()
        hits, todo = st.cache_split(prompts, keys, ["group_hash"])
    else:
        hits, todo = prompts.limit(0), prompts
    responses = cut_lineage(disc.respond(todo, responder, cfg.discovery_model, "constellations",
                                         DISCOVERY_PROMPT_VERSION, disc.DISCOVERY_SYSTEM, cfg.discovery_concurrency,
                                         max_tokens=cfg.discovery_max_tokens, log=_reply_log(store, "constellations"),
                                         calls_per_task=cfg.calls_per_task, per_minute=cfg.calls_per_minute))
    group_members = None
    if cfg.validate_replies:
        group_members = members.join(prompts.select("neighborhood_id", "group_hash"), "neighborhood_id") \
            .select("group_hash", "idea_id")
    fresh = disc.parse_constellations(responses, cfg.min_constellation_score, cfg.validate_replies,
                                      group_members).rows
    if cached is not None and not force:
        hit_rows = cached.join(hits.select(F.col("group_hash").alias("neighborhood_hash")), "neighborhood_hash",
                               "left_semi")
        out = disc.merge_cached_constellations(hit_rows, fresh, cfg.discovery_model, extra=["item_ord"])
    else:
        out = fresh
    if store is not None:
        run_id = store.next_part("constellations")
        to_store = fresh.select(*disc.merge_columns())
        if cfg.cache_empty:
            to_store = to_store.unionByName(disc.empty_sentinels(responses, fresh, cfg.discovery_model,
                                                                 DISCOVERY_PROMPT_VERSION))
        to_store = to_store.withColumn("created_at", F.current_timestamp())
        store.append("constellations", st.append_run(None, to_store, run_id), run_id)  # nothing stored is rewritten
    return out, responses, hits


def stage4(assign: DataFrame, ideas: DataFrame, responder: Callable, cfg: PipelineConfig,
           store: st.SnapshotStore | None = None, force: bool = False):
    prompts = disc.cluster_prompts(assign, ideas, cfg)
    cached = store.merged("patterns", PATTERN_KEY) if store is not None else None
    if cached is not None and not force:
        valid = cached.where(F.col("prompt_version") == PATTERNS_PROMPT_VERSION)
        keys = valid.select(F.col("cluster_hash").alias("group_hash")).distinct()
        hits, todo = st.cache_split(prompts, keys, ["group_hash"])
    else:
        hits, todo = prompts.limit(0), prompts
    responses = cut_lineage(disc.respond(todo, responder, cfg.patterns_model, "patterns", PATTERNS_PROMPT_VERSION,
                                         disc.PATTERNS_SYSTEM, cfg.discovery_concurrency, max_tokens=cfg.patterns_max_tokens,
                                         log=_reply_log(store, "patterns"), calls_per_task=cfg.calls_per_task,
                                         per_minute=cfg.calls_per_minute))
    fresh = disc.parse_patterns(responses).rows
    if cached is not None and not force:
        hit_rows = valid.join(hits.select(F.col("group_hash").alias("cluster_hash")), "cluster_hash", "left_semi") \
            .withColumn("model", F.lit(cfg.patterns_model)).drop("created_at")
        out = hit_rows.unionByName(fresh, allowMissingColumns=True)
    else:
        out = fresh
    if store is not None:
        # a group one of whose parts failed is asked again as a whole in the next run
        failed = responses.where(F.col("status") != "ok").select(F.col("group_hash").alias("cluster_hash")).distinct()
        new = fresh.join(failed, "cluster_hash", "left_anti").withColumns(
            {"write_seq": F.lit(store.next_part("patterns")), "created_at": F.current_timestamp()})
        # parts of one reply may repeat a title: the last one counts
        store.upsert("patterns", st.upsert_latest(new, PATTERN_KEY, "item_ord"), PATTERN_KEY)
    return out, responses, hits


def run(ideas: DataFrame, responder: Callable, cfg: PipelineConfig = DEFAULT_CONFIG, embedder=None,
        store: st.SnapshotStore | None = None, force: bool = False, pattern_responder: Callable | None = None) -> Result:
    """End-to-end run; returns DataFrames (nothing is collected but k-sized counters).

    ``responder`` serves the discovery stage and, unless ``pattern_responder`` is given, the theme
    stage too. A responder with ``model`` and ``max_tokens`` parameters is given the stage's model
    and reply limit.
    """
    began = time.monotonic()
    pattern_responder = pattern_responder or responder
    loadable = ingest.loadable(ideas)
    report.require_min_ideas(loadable, 3)
    s1 = stage1(loadable, cfg, embedder, store, force)
    total = s1.vectors.n_docs if isinstance(s1.vectors, tf.Vectors) else loadable.count()
    s2 = stage2(s1, cfg)
    members = cut_lineage(s2.members)
    constellations, r3, h3 = stage3(members, loadable, responder, cfg, store, force)
    if cfg.enforce_budget and led.cost_total(led.ledger_from_responses(r3)).first()[0] > cfg.cost_budget_usd:
        no_prompts = disc.cluster_prompts(s1.assignments, loadable, cfg).limit(0)
        r4 = disc.respond(no_prompts, pattern_responder, cfg.patterns_model, "patterns", PATTERNS_PROMPT_VERSION,
                          disc.PATTERNS_SYSTEM, 1)
        patterns, h4 = disc.parse_patterns(r4).rows, no_prompts
    else:
        patterns, r4, h4 = stage4(s1.assignments, loadable, pattern_responder, cfg, store, force)
    responses = r3.unionByName(r4)
    ledger = led.ledger_from_responses(responses)
    spark = ideas.sparkSession
    # the metadata row is built from scalars (each a small aggregate), not by joining one-row frames
    c3 = disc.call_counters(r3, h3.select("group_hash")).first()
    c4 = disc.call_counters(r4, h4.select("group_hash")).first()
    cost = led.cost_total(ledger).first()[0]
    bytype = {r[0]: r[1] for r in report.by_type(constellations).collect()}  # at most the distinct types
    meta = spark.createDataFrame(
        [(int(total), s2.intra_count, s2.cross_count, s2.total, sum(bytype.values()), bytype,
          c3["cache_hits"], c3["api_calls"], c4["cache_hits"], c4["api_calls"], float(cost),
          float(cost) > cfg.cost_budget_usd, int((time.monotonic() - began) * 1000))],
        "total_ideas long, neighborhoods_intra int, neighborhoods_cross int, neighborhoods_total int, "
        "constellations_found long, constellations_by_type map<string,bigint>, constellation_cache_hits long, "
        "constellation_api_calls long, pattern_cache_hits long, pattern_api_calls long, "
        "estimated_cost_usd double, over_budget boolean, elapsed_ms long")
    return Result(constellations, patterns, report.ideas_lookup(loadable), meta, responses, members)


def write_result(result: Result, path: str, fmt: str = "json") -> None:
    """Sink: the four result datasets side by side (``constellations/ patterns/ ideas/ metadata/``)."""
    for name in ("constellations", "patterns", "ideas", "metadata"):
        getattr(result, name).write.mode("overwrite").format(fmt).save(f"{path.rstrip('/')}/{name}")


def result_document(result: Result, max_bytes: int = 64 << 20) -> DataFrame:
    """The result as one JSON document (one row, column ``value``): lists of constellations and patterns, an
    object of ideas by id, the metadata object. Rows are in the order of their JSON text; nulls are written.

    For small results: the rows are measured first, and more than ``max_bytes`` of them raise ``ValueError``
    (``write_result`` has no bound).
    """
    def rows(name):
        df = getattr(result, name)
        js = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"})
        if name == "ideas":
            js = F.concat(F.lit('"'), F.col("idea_id").cast("string"), F.lit('":'), js)
        return df.select(F.lit(name).alias("name"), js.alias("js"))

    names = ("constellations", "patterns", "ideas", "metadata")
    parts = cut_lineage(rows(names[0]).unionAll(rows(names[1])).unionAll(rows(names[2])).unionAll(rows(names[3])))
    size = parts.agg(F.sum(F.octet_length("js"))).first()[0] or 0
    if size > max_bytes:
        raise ValueError(f"a result of {size} bytes is above the bound of {max_bytes} for one document")

    def part(name):
        return F.array_join(F.array_sort(F.collect_list(F.when(F.col("name") == name, F.col("js")))), ",")

    return parts.agg(F.concat(F.lit('{"constellations":['), part(names[0]), F.lit('],"patterns":['), part(names[1]),
                              F.lit('],"ideas":{'), part(names[2]), F.lit('},"metadata":'), part(names[3]),
                              F.lit("}")).alias("value"))
