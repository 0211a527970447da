"""queries() vs oracle_sql() on the smallest tables (the driver runs the same at sf0.01)."""

import math

import duckdb
import pytest

import __spark_entry__ as E

from .conftest import SF001

FAST = ["load_ideas", "tfidf_weights", "ingest_dedup", "kmeans_two_steps", "neighborhoods_capped",
        "parse_constellations", "cost_by_stage", "src_github", "export_ideas", "set_hash"]


def _norm(v):
    if isinstance(v, float):
        return round(v, 6) if not math.isnan(v) else "nan"
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "events", "part", "lineitem", "customer"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", FAST)
def test_matches_sql(spark, con, name):
    df = E.queries()[name](spark, SF001)
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    key = sorted(df.columns)
    a = sorted((tuple(_norm(r[c]) for c in key) for r in df.collect()), key=repr)
    idx = [ocols.index(c) for c in key]
    b = sorted((tuple(_norm(r[i]) for i in idx) for r in res.fetchall()), key=repr)
    assert a == b


def test_every_oracle_key_is_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
