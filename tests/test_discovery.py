import json

from ideaweave.operators import discovery as disc

CFG_MIN = 6

from .standin import fake_responder


def _responses(spark, texts):
    rows = [(f"h{i}", "v", "m", "constellations", t, 10, 5, "ok", None) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, disc.RESPONSE_SCHEMA)


def test_parse_edge_cases(spark):
    c = lambda **kw: dict({"type": "chain", "idea_ids": [1, 2, 3], "title": "t", "explanation": "e"}, **kw)
    texts = [
        "no json here",
        'x {"constellations": [{"type": "chain" "score": 7}]}',
        '{"constellations": []}',
        '{"other": 1}',
        "Here:\n" + json.dumps({"constellations": [
            c(score=5), c(score=6), c(type="absence", score=9, actionability=14),
            c(type="absence", score=9, actionability="7"), c(type="absence", score=9, actionability=0),
            c(type="absence", score=9, actionability=2.5), c(score=8, actionability=4), c(title="no score")]}) + "\nbye",
    ]
    p = disc.parse_constellations(_responses(spark, texts), CFG_MIN)
    rows = sorted((r["item_ord"], r["score"], r["actionability"]) for r in p.rows.collect())
    assert rows == [(1, 6.0, None), (2, 9.0, 10), (3, 9.0, None), (4, 9.0, 1), (5, 9.0, 3), (6, 8.0, None)]
    errs = sorted((r["group_hash"], r["reason"]) for r in p.errors.collect())
    assert errs == [("h0", "no json"), ("h1", "malformed json"), ("h4", "missing score")]


def test_patterns_default_ids(spark):
    r = _responses(spark, ['{"patterns": [{"name": "a", "explanation": "b"}, {"name": "c", "idea_ids": [4]}]}'])
    rows = sorted((x["pattern_title"], x["idea_ids"]) for x in disc.parse_patterns(r).rows.collect())
    assert rows == [("a", []), ("c", [4])]


def test_retry_then_isolation(spark):
    calls = {"n": 0}

    def flaky(prompt, system):
        if "boom" in prompt:
            raise RuntimeError("bad request")
        calls["n"] += 1
        if calls["n"] == 1:
            raise disc.ResponderError("rate limited", 429)
        return '{"constellations": []}', 3, 4

    assert disc._with_retry(lambda: flaky("ok", "s"), sleep=lambda s: None) == ('{"constellations": []}', 3, 4)
    prompts = spark.createDataFrame([("a", "ok"), ("b", "boom")], "group_hash string, prompt string")
    out = disc.respond(prompts, lambda p, s: ('{"x": 1}', 1, 1) if "ok" in p else flaky(p, s), "m", "st", "v",
                       "sys", concurrency=2)
    st = {r["group_hash"]: r["status"] for r in out.collect()}
    assert st == {"a": "ok", "b": "error"}


def test_fake_responder_is_deterministic():
    p = '[ID:4] "a" (s, c): d\n[ID:9] "b" (s, c): d\n[ID:2] "c" (s, c): d'
    assert fake_responder(p, "s") == fake_responder(p, "s")
    body = json.loads(fake_responder(p, "s")[0].split("\n", 1)[1])
    assert body["constellations"][0]["idea_ids"] == [4, 9, 2]


def test_validation(spark):
    texts = [json.dumps({"constellations": [
        {"type": "chain", "idea_ids": [1, 2], "score": 9}, {"type": "bogus", "idea_ids": [1, 2, 3], "score": 9},
        {"type": "spectrum", "idea_ids": [1, 2, 3], "score": 9}, {"type": "chain", "idea_ids": [1, 2, 99], "score": 9}]})]
    r = _responses(spark, texts)
    members = spark.createDataFrame([("h0", 1), ("h0", 2), ("h0", 3)], "group_hash string, idea_id long")
    got = disc.parse_constellations(r, CFG_MIN, validate=True, members=members).rows
    assert [x["item_ord"] for x in got.collect()] == [2]


def test_cluster_hash_is_one_formula_at_every_size(spark):
    import hashlib

    from ideaweave.config import DEFAULT_CONFIG
    sizes = {0: 500, 1: 60, 2: 3, 3: 2}
    rows = [(i * 4 + c - 7, c) for c, n in sizes.items() for i in range(n)]
    assign = spark.createDataFrame(rows, "idea_id long, cluster_id int").repartition(5)
    ideas = assign.selectExpr("idea_id", "'t' AS title", "'s' AS source", "'c' AS category", "'d' AS description")
    want = {c: (hashlib.sha256(",".join(map(str, sorted(i for i, k in rows if k == c))).encode()).hexdigest(), n)
            for c, n in sizes.items() if n >= 3}
    for most in (7, 100, 100_000):
        cfg = DEFAULT_CONFIG.replace(max_hash_members=most)
        got = disc.cluster_prompts(assign, ideas, cfg).select("cluster_id", "group_hash", "n_members").distinct().collect()
        assert {r["cluster_id"]: (r["group_hash"], r["n_members"]) for r in got} == want and len(got) == len(want)


def test_stored_replies_equal_the_stand_in_and_miss_plainly(spark):
    from ideaweave.operators import discovery as disc
    from ideaweave.sources import testdata as td
    texts = ["[ID:4] a\n[ID:5] b\n[ID:61] c\n[ID:7] d", 'themes {"patterns"} [ID:1] x [ID:2] y', "no ids", *[f"[ID:{i}] q{i}" for i in range(30)]]
    prompts = spark.createDataFrame([(f"h{i}", t) for i, t in enumerate(texts)], "group_hash string, prompt string")
    got = {r["group_hash"]: (r["text"], r["input_tokens"], r["output_tokens"])
           for r in disc.respond(prompts, disc.StoredReplies(td.stored_replies), "m", "s", "v", "sys").collect()}
    assert got == {f"h{i}": fake_responder(t, "sys") for i, t in enumerate(texts)}
    some = disc.StoredReplies(lambda p: td.stored_replies(p.where("group_hash <> 'h2'")))
    bad = disc.respond(prompts, some, "m", "s", "v", "sys").where("status <> 'ok'").collect()
    assert [(r["group_hash"], r["text"], r["error"]) for r in bad] == [("h2", None, "no stored reply")]


def test_theme_prompts_exchange_their_texts_once(spark):
    """Ids are ranked, not texts; a stored reply is found by the hash of its prompt."""
    import re

    from ideaweave.config import DEFAULT_CONFIG
    from ideaweave.sources import testdata as td
    from .conftest import SF001
    ideas = td.ideas(spark, SF001)
    assign = ideas.selectExpr("idea_id", "0 AS cluster_id")
    plan_of = lambda df: df._jdf.queryExecution().executedPlan().toString()
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as on large tables
    try:
        prompts = disc.cluster_prompts(assign, ideas, DEFAULT_CONFIG.replace(max_prompt_ideas=40))
        assert "Exchange hashpartitioning(idea_id" not in plan_of(prompts)
        replies = disc.respond(prompts, disc.StoredReplies(td.stored_replies), "m", "patterns", "v", "s")
        keys = re.findall(r"hashpartitioning\(group_hash#\w+, (\w+)#", plan_of(replies))
        assert keys and set(keys) == {"key"}
        got, rows = prompts.orderBy("part").collect(), replies.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    ids = sorted(r["idea_id"] for r in assign.collect())
    assert [re.findall(r"\[ID:(-?\d+)\]", r["prompt"])[0] for r in got] == [str(i) for i in ids[::40]]
    assert len(rows) == len(got) and {r["status"] for r in rows} == {"ok"}
