import pytest

from ideaweave.operators import ledger as led
from ideaweave.operators import store as st

LEDGER = "model string, stage string, input_tokens long, output_tokens long"


def test_cost_rules(spark):
    one = spark.createDataFrame([("claude-haiku-4-5-20251001", "s", 2_500_000, 300_000)], LEDGER)
    assert led.cost_total(one).first()[0] == pytest.approx(3.20)
    mix = spark.createDataFrame([("claude-haiku-4-5-20251001", "a", 1_000_000, 0), ("nope", "b", 5, 5),
                                 ("nope", "a", 7, 1)], LEDGER)
    assert led.cost_total(mix).first()[0] == pytest.approx(0.8)
    assert {r[0] for r in led.cost_by_stage(mix).collect()} == {"a"}
    assert {r[0]: (r[1], r[2]) for r in led.tokens_by_stage(mix).collect()} == {"a": (1_000_007, 1), "b": (5, 5)}
    unknown = spark.createDataFrame([("nope", "a", 7, 1)], LEDGER)
    assert led.cost_total(unknown).first()[0] == 0.0
    assert led.over_budget(one, 1.0).first()["over_budget"] is True


def test_embedding_upsert_last_write_wins(spark):
    old = spark.createDataFrame([(1, "vec-old", [0.5, -0.5]), (2, "vec-old", [1.0])],
                                "idea_id long, model string, vec array<double>")
    new = spark.createDataFrame([(1, "vec-new", [9.0, 8.0])], "idea_id long, model string, vec array<double>")
    got = {r[0]: (r[1], r[2]) for r in st.upsert(old, new, ["idea_id"]).collect()}
    assert got == {1: ("vec-new", [9.0, 8.0]), 2: ("vec-old", [1.0])}


def test_snapshot_store_clear_and_versions(spark, tmpdir_path):
    s = st.SnapshotStore(spark, tmpdir_path)
    assert s.read("x") is None
    s.write("ideas", spark.range(5))
    s.write("emb", spark.range(3))
    s.clear("emb", "id long")
    assert s.read("ideas").count() == 5 and s.read("emb").count() == 0
    assert s.latest("emb") == 2


def test_pattern_upsert_and_split(spark):
    rows = spark.createDataFrame([("h", "t", "v", "old", 1), ("h", "t", "v", "new", 2), ("h", "u", "v", "x", 1)],
                                 "cluster_hash string, pattern_title string, prompt_version string, "
                                 "pattern_description string, write_seq int")
    got = {r[1]: r[3] for r in st.upsert_latest(rows, ["cluster_hash", "pattern_title", "prompt_version"]).collect()}
    assert got == {"t": "new", "u": "x"}
    req = spark.createDataFrame([("a",), ("b",)], "k string")
    cache = spark.createDataFrame([("a",)], "k string")
    hits, miss = st.cache_split(req, cache, ["k"])
    assert [r[0] for r in hits.collect()] == ["a"] and [r[0] for r in miss.collect()] == ["b"]
    hits, miss = st.cache_split(req, cache, ["k"], force=True)
    assert hits.count() == 0 and miss.count() == 2


def test_export_counts_report_both(spark):
    from ideaweave.operators import report as rep
    ideas = spark.createDataFrame([(1, "a", "d", "s", "", "x", ""), (2, "b", "d", "s", "", "y", ""),
                                   (3, "c", "d", "s", "u", "z", "")],
                                  "idea_id long, title string, description string, source string, url string, "
                                  "category string, stack string")
    out = rep.export_ideas(ideas)  # empty urls collapse to the first id
    assert sorted(r["id"] for r in out.collect()) == [1, 3]
    row = rep.export_ideas(ideas, "2026-03-04").where("id = 3").first()
    assert (row["fecha"], row["revisado"], row["apto_inversores"], row["notas"]) == ("2026-03-04", "pendiente", "pendiente", "")
    got = rep.export_counts({"ideas": ideas}, {"ideas": out}).collect()
    assert [(r[0], r[1], r[2]) for r in got] == [("ideas", 3, 2)]


def test_upsert_writes_what_is_new_and_merges_on_read(spark, tmpdir_path):
    s, key = st.SnapshotStore(spark, tmpdir_path), ["k"]
    row = lambda *x: spark.createDataFrame(list(x), "k long, v string")
    want = {}
    assert s.merged("t", key) is None
    for n in range(1, 8):
        new = {i: f"{n}-{i}" for i in ([*range(50)] if n == 1 else [n, n * 10])}
        want |= new
        s.upsert("t", row(*new.items()), key, compact_after=5)
        assert {r["k"]: r["v"] for r in s.merged("t", key).collect()} == want
    sizes = {r[0]: r[1] for r in spark.read.parquet(tmpdir_path + "/t").groupBy("seq").count().collect()}
    assert sizes[2] == 2 and sizes[6] == len(want) - len({6, 7, 60, 70} - set(range(50)))  # part 6 is the merged one
    assert s._parts("t") == [6, 7, 8]
    s.drop_parts("t")
    assert s.merged("t", key) is None and s.next_part("t") == 9
