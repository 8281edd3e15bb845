"""Every registered query against its DuckDB oracle on the smallest tables."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry
from monthledger.plans import oracle, queries
from conftest import SMALL_SF

NAMES = sorted(queries.queries())


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v)
    if isinstance(v, Decimal):
        return repr(float(v))
    if isinstance(v, dt.datetime):
        return v.date().isoformat() if v.time() == dt.time() else v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(cols), Counter(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("orders", "lineitem", "customer"):
        con.execute(f"create view {t} as select * from read_parquet('{SMALL_SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(oracle.oracle_sql()) == set(NAMES) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name, tmp_path):
    df = entry.queries()[name](spark, SMALL_SF)
    assert len(set(df.columns)) == len(df.columns)
    df.write.parquet(str(tmp_path / "out"))
    df = spark.read.parquet(str(tmp_path / "out"))
    s_cols, s_rows = _bag(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(entry.oracle_sql()[name])
    d_cols, d_rows = _bag([c[0] for c in cur.description], cur.fetchall())
    assert s_cols == d_cols
    assert s_rows == d_rows


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["payment_status", "usi", "mpn"]
    assert df.count() > 0
