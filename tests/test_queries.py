"""Every registered query against its SQL."""

from __future__ import annotations

import math

import duckdb
import pytest

from quaverlake.queries import ORACLE_SQL, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "null"
    return f"{v:.6f}" if isinstance(v, float) else str(v)


@pytest.fixture(scope="module")
def duck(data):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, data, duck, name):
    df = QUERIES[name](spark, data)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    if name not in ORACLE_SQL:
        assert got
        return
    want = duck.sql(ORACLE_SQL[name])
    assert sorted(want.columns) == columns
    at = [want.columns.index(c) for c in columns]
    assert got == sorted(tuple(plain(r[i]) for i in at) for r in want.fetchall())


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
