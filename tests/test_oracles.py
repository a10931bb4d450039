"""Every registered query against its DuckDB oracle on sf0.001."""

import decimal
import datetime as dt
import math
import os

import duckdb
import pytest

import __spark_entry__ as E

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else f"{round(v, 6):.6f}"
    if isinstance(v, decimal.Decimal):
        return f"{float(v):.6f}"
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return str(v)


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows), sorted(cols)


@pytest.fixture(scope="module")
def con(sf_small):
    c = duckdb.connect()
    for t in TABLES:
        p = f"{sf_small}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_registered_with_oracle_or_bruteforce():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert {k for k in set(q) - set(o) if k != "pipeline" and not k.startswith("op")} == set()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "faturamento_total" in df.columns


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, sf_small, con, name):
    sdf = E.queries()[name](spark, sf_small)
    s_rows, s_cols = _canon(sdf.columns, [tuple(r) for r in sdf.collect()])
    cur = con.execute(E.oracle_sql()[name])
    o_rows, o_cols = _canon([d[0] for d in cur.description], cur.fetchall())
    assert s_cols == o_cols
    assert len(s_rows) == len(o_rows)
    assert s_rows == o_rows
