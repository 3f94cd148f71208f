"""The driver contract: ``entry`` runs; every query with an oracle matches DuckDB on sf0.001 (rows and values)."""
import hashlib
import os

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from stridex.queries import ORACLE

TABLES = ["events", "customer"]
NAMES = sorted(ORACLE)


def _digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(repr(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["user_id", "n"]


def test_every_query_registered():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows, cols = [tuple(r) for r in df.collect()], df.columns
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _digest(rows, cols) == _digest(orows, ocols)
