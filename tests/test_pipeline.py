from pyspark.sql import functions as F

from ideaweave.config import DEFAULT_CONFIG
from ideaweave.operators import discovery as disc
from ideaweave.operators import report as rep
from ideaweave.operators.embedders import DenseEmbedder, hashing_model
from ideaweave.operators.store import SnapshotStore
from ideaweave.plans import pipeline as pl

from .standin import fake_responder


def _ideas(spark):
    topics = ["vector database search", "static site generator", "rust async runtime", "llm agent framework",
              "open source analytics", "mobile budget app"]
    rows = [(i + 1, f"{topics[i % 6]} {i}", f"A {topics[i % 6]} project number {i} with {topics[(i + 1) % 6]}",
             "gh" if i % 2 else "hn", f"https://x/{i}", ["dev", "", "data"][i % 3], "") for i in range(48)]
    return spark.createDataFrame(rows, "idea_id long, title string, description string, source string, "
                                       "url string, category string, stack string")


def test_run_and_cache_reuse(spark, tmpdir_path):
    cfg = DEFAULT_CONFIG.replace(num_clusters=6)
    store = SnapshotStore(spark, tmpdir_path)
    r1 = pl.run(_ideas(spark), fake_responder, cfg, store=store)
    m1 = r1.metadata.first()
    assert m1["total_ideas"] == 48 and m1["constellation_cache_hits"] == 0
    assert m1["neighborhoods_total"] == m1["neighborhoods_intra"] + m1["neighborhoods_cross"]
    assert m1["constellation_api_calls"] == m1["neighborhoods_total"]
    groups_with_rows = r1.constellations.select("neighborhood_hash").distinct().count()
    n1 = r1.constellations.count()
    r2 = pl.run(_ideas(spark), fake_responder, cfg, store=store)
    m2 = r2.metadata.first()
    assert m1["elapsed_ms"] > 0
    for stored in (store.read_parts("constellations"), store.merged("patterns", pl.PATTERN_KEY)):
        assert stored.where("created_at is null").count() == 0 and "created_at" in rep.export_constellations(stored).columns
    # groups that produced constellations are served from the cache; empty ones are asked again
    assert m2["constellation_cache_hits"] == groups_with_rows
    assert m2["constellation_api_calls"] == m1["neighborhoods_total"] - groups_with_rows
    assert r2.constellations.count() == n1
    assert m2["pattern_api_calls"] == 0 or m2["pattern_cache_hits"] > 0
    # the second run reused the cached vectors and found the same clusters
    a1 = {r[0]: r[1] for r in pl.stage1(_ideas(spark), cfg, store=store).assignments.collect()}
    s1b = pl.stage1(_ideas(spark), cfg, store=store)
    assert s1b.reused and {r[0]: r[1] for r in s1b.assignments.collect()} == a1
    assert len(set(a1.values())) <= 6 and set(a1) == set(range(1, 49))
    # every constellation id list names ideas from the corpus
    ids = {r[0] for r in r2.constellations.select(F.explode("idea_ids")).collect()}
    assert ids <= set(range(1, 49))


def test_dense_vectors_are_cached(spark, tmpdir_path):
    calls = spark.sparkContext.accumulator(0)
    plain = hashing_model(16)

    def counted(docs):
        calls.add(len(docs))
        return plain(docs)

    model = DenseEmbedder("counted_v1", counted, 16)
    store, cfg, ideas = SnapshotStore(spark, tmpdir_path), DEFAULT_CONFIG.replace(num_clusters=4), _ideas(spark)
    first = pl.stage1(ideas.where("idea_id <= 40"), cfg, model, store)
    assert calls.value == 40 and not first.reused
    again = pl.stage1(ideas.where("idea_id <= 40"), cfg, model, store)
    assert calls.value == 40 and again.reused
    assert sorted(again.assignments.collect()) == sorted(first.assignments.collect())
    more = pl.stage1(ideas, cfg, model, store)
    assert calls.value == 48 and more.assignments.count() == 48
    part = pl.stage1(ideas.where("idea_id > 30"), cfg, model, store)
    assert calls.value == 48 and part.assignments.count() == 18
    pl.stage1(ideas, cfg, DenseEmbedder("other_v1", counted, 16), store)
    assert calls.value == 96
    assert store.merged("embeddings", ["idea_id", "model"]).groupBy("model").count().count() == 2


def test_model_reaches_the_responder_of_each_stage(spark):
    def named(prompt, system, model, max_tokens):
        return f"{model} {max_tokens}", 1, 1

    prompts = spark.createDataFrame([("h1", "p1"), ("h2", "p2")], "group_hash string, prompt string")
    got = disc.respond(prompts, named, "m7", "patterns", "v", "s", max_tokens=9).collect()
    assert [r["text"] for r in got] == ["m7 9", "m7 9"]

    def themes(prompt, system):
        raise ValueError("themes are off")

    r = pl.run(_ideas(spark), fake_responder, DEFAULT_CONFIG.replace(num_clusters=6), pattern_responder=themes)
    status = {(x["stage"], x["status"]) for x in r.responses.collect()}
    assert status == {("constellations", "ok"), ("patterns", "error")}


def test_minimum_ideas(spark):
    import pytest
    few = _ideas(spark).limit(2)
    with pytest.raises(ValueError):
        pl.run(few, fake_responder, DEFAULT_CONFIG)


def test_forced_rerun_does_not_duplicate_and_budget(spark, tmpdir_path):
    cfg = DEFAULT_CONFIG.replace(num_clusters=6, validate_replies=True)
    store = SnapshotStore(spark, tmpdir_path)
    r1 = pl.run(_ideas(spark), fake_responder, cfg, store=store)
    n1 = r1.constellations.count()
    r2 = pl.run(_ideas(spark), fake_responder, cfg, store=store, force=True)
    assert r2.constellations.count() == n1
    r3 = pl.run(_ideas(spark), fake_responder, cfg, store=store)
    assert r3.constellations.count() == n1 and r3.metadata.first()["constellation_cache_hits"] > 0
    tight = cfg.replace(enforce_budget=True, cost_budget_usd=0.0)
    m = pl.run(_ideas(spark), fake_responder, tight).metadata.first()
    assert m["pattern_api_calls"] == 0 and m["over_budget"]


def test_cache_empty_sentinels(spark, tmpdir_path):
    def picky(prompt, system):
        text, a, b = fake_responder(prompt, system)
        return (text if "[ID:1]" in prompt else '{"constellations": []}'), a, b

    cfg = DEFAULT_CONFIG.replace(num_clusters=6, cache_empty=True)
    store = SnapshotStore(spark, tmpdir_path)
    m1 = pl.run(_ideas(spark), picky, cfg, store=store).metadata.first()
    m2 = pl.run(_ideas(spark), picky, cfg, store=store).metadata.first()
    assert m2["constellation_api_calls"] == 0
    assert m2["constellation_cache_hits"] == m1["neighborhoods_total"]
    assert m2["constellations_found"] == m1["constellations_found"]


def test_race_seeding(spark):
    from ideaweave.operators import kmeans as km
    df = spark.createDataFrame([(i, [float(i % 5), float(i % 3)]) for i in range(60)], "idea_id long, vec array<double>")
    res = km.kmeans_dense(df, 5, init="race")
    lab = {r[0]: r[1] for r in res.assignments.collect()}
    assert set(lab) == set(range(60)) and 1 < len(set(lab.values())) <= 5


def test_result_document(spark):
    import json

    import pytest
    some = spark.createDataFrame([("b", 7.5, None), ("a", 2.0, 'x "y"')], "title string, score double, note string")
    none = some.where("false")
    ideas = spark.createDataFrame([(i, f"t{i}", None) for i in (3, 20, 1)], "idea_id long, title string, url string")
    meta = spark.createDataFrame([(3, [("tension", 2)])], "total_ideas long, by_type array<struct<name:string,n:long>>")
    got = pl.result_document(pl.Result(some, none, ideas, meta, none, none)).collect()
    assert len(got) == 1 and json.loads(got[0]["value"]) == {
        "constellations": [{"title": "a", "score": 2.0, "note": 'x "y"'}, {"title": "b", "score": 7.5, "note": None}],
        "patterns": [], "ideas": {str(i): {"idea_id": i, "title": f"t{i}", "url": None} for i in (1, 3, 20)},
        "metadata": {"total_ideas": 3, "by_type": [{"name": "tension", "n": 2}]}}
    with pytest.raises(ValueError):
        pl.result_document(pl.Result(some, none, ideas, meta, none, none), max_bytes=100)
