"""Every catalogue query against its DuckDB oracle on the smallest tables,
plus the driver's smoke entry."""

import math

import duckdb
import pytest

from __spark_entry__ import entry
from conftest import SF_SMALL
from quern.plans.catalog import QUERIES
from quern.plans.oracle import oracle_sql

TABLES = ["documents", "embeddings", "events", "lineitem", "part"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted(tuple(repr(_norm(r[i])) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    rel = con.sql(oracle_sql()[name])
    assert _canon(df.columns, [tuple(r) for r in df.collect()]) == _canon(rel.columns, rel.fetchall())


def test_entry_smoke(spark):
    df = entry(spark)
    rows = df.collect()
    assert rows and df.columns == ["cid", "w", "pos", "v"]
    assert sum({r.cid: r.w for r in rows}.values()) == 500
