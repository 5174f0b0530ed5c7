"""Every registered retail query against its DuckDB SQL twin on sf0.001
(the driver runs the same comparison on sf0.01)."""

import datetime as dt
import math
from decimal import Decimal

import duckdb
import pytest

from emporium.registry import ORACLE, QUERIES

SMOKE = "/root/testdata/sf0.001"

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, Decimal):
        return str(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def key(r):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in r)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) - set(ORACLE) == set()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_parity(spark, con, name):
    df = QUERIES[name](spark, SMOKE)
    s_cols = df.columns
    s_rows = [tuple(norm(x) for x in r) for r in df.collect()]
    cur = con.execute(ORACLE[name])
    d_cols = [d[0] for d in cur.description]
    assert sorted(s_cols) == sorted(d_cols)
    order = [d_cols.index(c) for c in s_cols]
    d_rows = [tuple(norm(r[i]) for i in order) for r in cur.fetchall()]
    assert len(s_rows) == len(d_rows)
    assert sorted(s_rows, key=key) == sorted(d_rows, key=key)


@pytest.mark.parametrize("name", ["bat_orders", "bat_stock_adjust"])
def test_parity_of_many_chunks_at_sf01(spark, name, monkeypatch):
    """Admission and signed balances on sf0.1 with chunks so small that hot
    products span several of them."""
    monkeypatch.setattr("emporium.operators.admission.CHUNK_ROWS", 2000)
    sf = "/root/testdata/sf0.1"
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    df = QUERIES[name](spark, sf)
    s_rows = [tuple(norm(x) for x in r) for r in df.collect()]
    cur = c.execute(ORACLE[name])
    d_cols = [d[0] for d in cur.description]
    order = [d_cols.index(col) for col in df.columns]
    d_rows = [tuple(norm(r[i]) for i in order) for r in cur.fetchall()]
    assert sorted(s_rows, key=key) == sorted(d_rows, key=key)
