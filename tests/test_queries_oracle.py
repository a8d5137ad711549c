"""Every registered query against its DuckDB oracle (sf0.001)."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from cdrflow.plans.queries import QUERIES
from sf_dirs import SF_SMALL

TABLES = ["region", "nation", "customer", "events"]
ORACLE = {k: v for k, v in entry.oracle_sql().items() if k in QUERIES}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return "\x00NULL" if math.isnan(v) else repr(v)
    return "\x00NULL" if v is None else str(v)


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def test_every_query_has_an_oracle_or_is_documented():
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) == set(ORACLE)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns == ["rate_plan_id", "revenue_TTC"]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLE[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _canon(df.columns, rows) == _canon(ocols, orows)
