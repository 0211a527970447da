import hashlib

from ideaweave.functions import text as tx


def test_set_hash_order_free_and_known(spark):
    df = spark.createDataFrame([([1, 2, 3],), ([3, 1, 2],), ([4, 5, 6],), ([10, 9],)], "ids array<long>")
    h = [r[0] for r in df.select(tx.set_hash("ids")).collect()]
    assert h[0] == h[1] == hashlib.sha256(b"1,2,3").hexdigest()
    assert h[0] != h[2]
    assert all(len(x) == 64 and all(c in "0123456789abcdef" for c in x) for x in h)
    # numeric sort before the string join: 9 before 10
    assert h[3] == hashlib.sha256(b"9,10").hexdigest()


def test_tokenize_rules(spark):
    df = spark.createDataFrame([("Hello, Wörld! ab abc ABC-123 x_y_z",)], "t string")
    toks = df.select(tx.tokenize("t")).first()[0]
    assert toks == ["hello", "rld", "abc", "abc", "123"]


def test_item_line_and_defaults(spark):
    df = spark.createDataFrame([(7, "T", "hn", "", "d" * 400)], "idea_id long, title string, source string, "
                               "category string, description string")
    line = df.select(tx.item_line(chars=300)).first()[0]
    assert line == '[ID:7] "T" (hn, uncategorized): ' + "d" * 300


def test_round_clamp_and_outer_json(spark):
    df = spark.createDataFrame([(0.0,), (14.0,), (2.5,), (6.49,), (-3.0,)], "x double")
    assert [r[0] for r in df.select(tx.round_clamp_1_10("x")).collect()] == [1, 10, 3, 6, 1]
    t = spark.createDataFrame([("pre {\"a\": {\"b\": 1}} mid } post",), ("no json",)], "t string")
    assert [r[0] for r in t.select(tx.outer_json_object("t")).collect()] == ['{"a": {"b": 1}} mid }', ""]


def test_embed_document(spark):
    df = spark.createDataFrame([("T", None, "x" * 600)], "title string, category string, description string")
    assert df.select(tx.embed_document(chars=500)).first()[0] == "T  " + "x" * 500
