"""Every registered query against its SQL on the smallest test data."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
# the corpus operators have tests of their own
CORPUS = set() if entry.corpus_queries is None else {*entry.corpus_queries.queries(), "pipeline"}
QUERIES = {name: query for name, query in entry.queries().items() if name not in CORPUS}
SQL = {name: sql for name, sql in entry.oracle_sql().items() if name not in CORPUS}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql(f"create view events as select * from '{SF}/events.parquet'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    return repr(float(value)) if isinstance(value, (int, float)) else str(value)


def comparable(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, SF)
    expected = duck.sql(SQL[name])
    assert sorted(got.columns) == sorted(expected.columns)
    rows = got.collect()
    assert comparable(got.columns, rows) == comparable(expected.columns, expected.fetchall())
    assert rows
