"""Every registered query vs its DuckDB oracle on the sf0.001 tables
(row count, column names, order-insensitive value hash), and the entry
contract."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as E
from tools.check_oracle import TABLES, digest

from .conftest import SF_SMALL

PLANS = sorted(E.queries())
SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_entry_contract(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "gmv" in df.columns
    assert set(SQL) <= set(E.queries())


@pytest.mark.parametrize("name", PLANS)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    cols, got = df.columns, [tuple(r) for r in df.collect()]
    if name not in SQL:
        assert len(got) > 0
        return
    cur = con.execute(SQL[name])
    ocols, want = [d[0] for d in cur.description], cur.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert len(got) == len(want)
    assert digest(cols, got)[0] == digest(ocols, want)[0]
