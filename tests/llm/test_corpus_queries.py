"""Queries against their SQL, and that every one of the eleven is there."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from quaverlake.llm.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query(spark, data, name):
    c = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    df = QUERIES[name](spark, data)
    columns = sorted(df.columns)
    want = c.sql(ORACLE_SQL[name])
    assert sorted(want.columns) == columns
    at = [want.columns.index(x) for x in columns]
    assert sorted(tuple(r[x] for x in columns) for r in df.collect()) == sorted(tuple(r[i] for i in at) for r in want.fetchall())


def test_registered():
    names = entry.queries()
    assert "pipeline" in names and {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 11)} and set(QUERIES) <= set(names)
