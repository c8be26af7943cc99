"""Every registered query against its DuckDB oracle on the smallest fixture."""

from collections import Counter
from decimal import Decimal

import duckdb
import pytest

from conftest import SF_SMALL

import __spark_entry__ as entry

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, Decimal):
        return str(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _bag(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in data)


def test_every_query_has_an_oracle():
    from martkit.plans.fixtures import ORACLE_SQL, QUERIES
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    res = con.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert len(got) == len(want)
    assert _bag(df.columns, got) == _bag(cols, want)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["partkey", "suppkey", "p_name", "average_rating"]
    assert df.count() > 0
