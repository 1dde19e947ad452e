"""Driver contract and the DuckDB oracles (sf0.001 here; the driver checks sf0.01)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from marquee.plans.queries import QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["year", "rank", "title", "votes", "rating"]
    assert df.count() > 0


def test_oracle_keys_are_queries():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(QUERIES) <= set(E.oracle_sql())


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    got = df.collect()
    cur = duck.execute(E.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(cols)
    idx = [cols.index(c) for c in df.columns]
    exp = cur.fetchall()
    a = sorted((tuple(_norm(r[c]) for c in df.columns) for r in got), key=repr)
    b = sorted((tuple(_norm(r[i]) for i in idx) for r in exp), key=repr)
    assert a == b
