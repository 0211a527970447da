import random

from pyspark.sql import functions as F

from ideaweave.config import DEFAULT_CONFIG
from ideaweave.operators import neighborhoods as nbh

from . import brute


def test_chunk_counts():
    got = {s: nbh.chunk_count(s, 20) for s in (2, 3, 30, 31, 41, 42, 43, 44, 66, 67)}
    assert got == {2: 0, 3: 1, 30: 1, 31: 1, 41: 1, 42: 2, 43: 2, 44: 2, 66: 3, 67: 3}


def test_cap_plan():
    assert nbh.cap_plan(10, 5, 50) == list(range(10))
    assert nbh.cap_plan(40, 10, 25) == list(range(0, 30, 2))
    assert nbh.cap_plan(100, 10, 50) == list(range(0, 80, 2))
    assert nbh.cap_plan(5, 50, 50) == []


def _fixture(spark, sizes, seed=3):
    rnd = random.Random(seed)
    rows, nid = [], 0
    for c, s in enumerate(sizes):
        for _ in range(s):
            rows.append((nid, c, [rnd.gauss(c, 1.0) for _ in range(4)]))
            nid += rnd.choice([1, 2])
    rnd.shuffle(rows)
    return spark.createDataFrame(rows, "idea_id long, cluster_id int, vec array<double>"), rows


def test_matches_brute_force(spark):
    sizes = [2, 3, 30, 31, 44, 67, 5, 12]
    df, rows = _fixture(spark, sizes)
    for cfg in (DEFAULT_CONFIG, DEFAULT_CONFIG.replace(max_total_neighborhoods=9, max_cross_cluster_neighborhoods=4)):
        res = nbh.neighborhoods(df, cfg)
        got = {}
        for r in res.members.collect():
            got.setdefault(r["neighborhood_id"], []).append((r["ordinal"], r["idea_id"]))
        got_lists = [[i for _, i in sorted(got[k])] for k in sorted(got)]
        by_c = {}
        for i, c, v in sorted(rows):
            by_c.setdefault(c, []).append(i)
        order = sorted(by_c, key=lambda c: min(by_c[c]))
        vecs = {i: v for i, _, v in rows}
        want, intra, cross = brute.neighborhoods([by_c[c] for c in order], vecs,
                                                 max_cross=cfg.max_cross_cluster_neighborhoods,
                                                 max_total=cfg.max_total_neighborhoods)
        assert got_lists == want
        assert (res.intra_count, res.cross_count, res.total) == (intra, cross, len(want))
        assert all(3 <= len(x) <= 41 for x in got_lists)


def test_rank_within_spreads_a_hot_group(spark):
    df = spark.range(0, 20000).select(F.col("id").alias("idea_id"),
                                      F.when(F.col("id") < 15000, 0).otherwise(F.col("id") % 3).alias("g"))
    r = nbh.rank_within(df, "g", ["idea_id"], partitions=8)
    hot = r.where(F.col("g") == 0)
    n_hot = df.where(F.col("g") == 0).count()
    assert hot.agg(F.min("rank"), F.max("rank"), F.countDistinct("rank")).first() == (1, n_hot, n_hot)
    assert r.where(F.col("g") == 0).select(F.spark_partition_id()).distinct().count() > 1


def test_relational_stage2_matches_matrix_path(spark, monkeypatch):
    from ideaweave.plans import pipeline as pl
    topics = ["vector search engine", "garden tomato soil", "rust async runtime", "budget mobile app"]
    rows = [(i, f"{topics[i % 4]} {i % 7}", f"notes on {topics[i % 4]} and {topics[(i * 3) % 4]} v{i % 5}",
             "s", f"u{i}", "", "") for i in range(130)]
    ideas = spark.createDataFrame(rows, "idea_id long, title string, description string, source string, url string, "
                                        "category string, stack string")
    cfg = DEFAULT_CONFIG.replace(num_clusters=5)
    a = pl.stage2(pl.stage1(ideas, cfg), cfg)
    rel = cfg.replace(centroid_broadcast_bytes=0)
    s1 = pl.stage1(ideas, rel)
    assert s1.rows is None  # relational path taken
    b = pl.stage2(s1, rel)
    key = lambda r: (r["neighborhood_id"], r["ordinal"], r["idea_id"])
    assert sorted(map(key, a.members.collect())) == sorted(map(key, b.members.collect()))
    assert (a.intra_count, a.cross_count) == (b.intra_count, b.cross_count)


def test_cap_as_arithmetic_equals_the_written_out_plan():
    for intra in range(0, 60):
        for cross in (0, 3, 10):
            for most in (None, 1, 5, 10, 11, 25, 60):
                cap = nbh.cap_rule(intra, cross, most)
                kept = [nb for nb in range(intra) if nb % cap.step == 0 and nb // cap.step < cap.count]
                room = intra if most is None or intra + cross <= most else max(most - cross, 0)
                want = list(range(intra))[::max(1, intra // room) if room and room < intra else 1][:room]
                assert kept == want == nbh.cap_plan(intra, cross, most)
                for first in range(intra):
                    for chunks in (1, 4):
                        inside = range(first, min(first + chunks, intra))
                        assert nbh.keeps_any(first, len(inside), cap) == any(x in kept for x in inside)


def test_plan_of_many_chunks_stays_as_large_as_the_clusters(spark):
    from ideaweave.config import CHUNK_SIZE
    plan = nbh.plan_intra([(c, 5_000_000, c) for c in range(4)], DEFAULT_CONFIG)
    assert plan.intra_total > 900_000 and all(len(x) == 4 for x in (plan.order, plan.sizes, plan.chunks, plan.first_nb))
    assert nbh.cap_rule(plan.intra_total, 5, 50).count == 45
    df = spark.range(0, 4000).select(F.col("id").alias("idea_id"), (F.col("id") % 4).cast("int").alias("cluster_id"),
                                     F.array(F.rand(1), F.rand(2)).alias("vec"))
    text = nbh.intra_members(df, nbh.plan_intra(nbh.cluster_sizes(df), DEFAULT_CONFIG))._jdf.queryExecution().toString()
    assert " IN (" not in text and " INSET " not in text and CHUNK_SIZE == 22


def test_positions_are_found_without_sorting_groups(spark):
    from ideaweave.operators.ranking import at_positions
    rnd = random.Random(4)
    ids = sorted(rnd.sample(range(1_000_000), 6000)) + list(range(2_000_000, 2_009_000))
    group = {i: 0 if i % 3 else 1 for i in ids}
    df = spark.createDataFrame([(i, c) for i, c in group.items()], "idea_id long, cluster_id int").repartition(6)
    by = {c: [i for i in ids if group[i] == c] for c in (0, 1)}
    want = [(n, c, p) for n, (c, p) in enumerate((c, p) for c in by for p in (1, 2, len(by[c]) // 2, len(by[c]), 77, 77))]
    for fanout, leaf in ((16, 50), (1 << 16, 4096)):
        got = {r["nb"]: r["idea_id"] for r in at_positions(df, "cluster_id", want, "nb int, cluster_id int, rank long",
                                                           fanout=fanout, leaf=leaf).collect()}
        assert got == {n: by[c][p - 1] for n, c, p in want}
