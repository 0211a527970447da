"""The pipeline against a plain version of its stages, and the SQL of the queries."""

import subprocess
import sys
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from ideaweave.llm import langid, secrets
from ideaweave.llm.queries import ORACLE, QUERIES

from ..conftest import SF001
from .test_text_operators import WORD, plain_components, plain_fingerprint, plain_leak, plain_targets


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "embeddings"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, con, name):
    df = QUERIES[name](spark, SF001)
    res = con.execute(ORACLE[name])
    columns = [d[0] for d in res.description]
    assert sorted(columns) == sorted(df.columns)
    a = sorted(map(repr, (tuple(r) for r in df.select(*columns).collect())))
    assert a == sorted(map(repr, (tuple(r) for r in res.fetchall())))


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").withColumn("language", F.lit("clash"))
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    was = [r.asDict() for r in docs.collect()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF001)
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        now = [r.asDict() for r in docs.collect()]
        if name == "language":
            assert {r["doc_id"] for r in now} <= {r["doc_id"] for r in was} and len(now) > 0.97 * len(was)
            assert all(langid.has_letter(r["text"]) for r in now)
        elif name == "near_duplicates":
            comp = plain_components([plain_fingerprint(r["text"]) for r in was], 4)
            low: dict = {}
            for r in was:
                c = comp[plain_fingerprint(r["text"])]
                low[c] = min(low.get(c, r["doc_id"]), r["doc_id"])
            assert {r["doc_id"] for r in now} == set(low.values()) and len(now) == len(low)
        elif name == "decontaminate":
            assert {r["doc_id"] for r in now} == {r["doc_id"] for r in was if plain_leak(r["text"], items)[1] == 0}
        elif name == "secrets":
            old = {r["doc_id"]: r["text"] for r in was}
            assert {r["doc_id"] for r in now} == set(old)
            for r in now:
                spans = secrets.scanner().scan(old[r["doc_id"]])
                assert r["text"] == secrets.redact(old[r["doc_id"]], spans) and r["n_chars"] == len(r["text"])
        else:
            sizes: Counter = Counter()
            for r in was:
                sizes[r["source"]] += len(WORD.findall(r["text"]))
            want = plain_targets(dict(sizes))
            taken: Counter = Counter()
            for r in now:
                taken[r["source"]] += r["taken"]
            assert all(abs(taken[s] - want[s]) <= 1 for s in sizes)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert list(now[0]) == list(was[0])
        was = now


def test_registered():
    names = entry.queries()
    assert {f"op{n}" for n in range(1, 14)} == {n.split("_")[0] for n in QUERIES} and {*QUERIES, "pipeline"} <= set(names)


def test_rest_imports_without_the_text_operators():
    code = ("import sys\n"
            "class Gone:\n"
            "    def find_spec(self, name, path=None, target=None):\n"
            "        if name in ('corpus_pipeline', 'ideaweave.llm') or name.startswith('ideaweave.llm.'):\n"
            "            raise ModuleNotFoundError(name=name)\n"
            "sys.meta_path.insert(0, Gone())\n"
            "import __spark_entry__ as e\n"
            "assert not [n for n in e.queries() if n.startswith('op') or n == 'pipeline']\n")
    subprocess.run([sys.executable, "-c", code], check=True, cwd=entry.__file__.rsplit("/", 1)[0])
