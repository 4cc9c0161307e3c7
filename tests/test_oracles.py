"""Every query with a DuckDB twin gives the twin's rows; the others give rows of a stable schema."""

from __future__ import annotations

import math

import duckdb
import pytest
from conftest import DATA

from loamworks.plans import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    return None if value is None else str(value)


def in_order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or "") for x in r))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_duckdb(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    found = in_order(tuple(plain(r[c]) for c in columns) for r in df.collect())
    rel = duck.sql(ORACLES[name])
    assert sorted(rel.columns) == columns
    at = [rel.columns.index(c) for c in columns]
    assert found == in_order(tuple(plain(r[i]) for i in at) for r in rel.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, name):
    df = QUERIES[name](spark, DATA)
    assert df.columns and df.count() > 0
