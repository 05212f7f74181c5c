from __future__ import annotations

import decimal

import duckdb
import pytest

TABLES = ("documents", "labels", "embeddings")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def against_sql(spark):
    """Compare a registered query with its SQL on the smallest tables, row by row."""
    from vitalgrid.llm import oracle, queries

    def plain(value):
        if isinstance(value, decimal.Decimal):
            return float(value)
        return round(value, 6) if isinstance(value, float) else value

    def compare(name, sf=SF):
        mine = queries.queries()[name](spark, sf)
        names = sorted(mine.columns)
        con = duckdb.connect()
        for table in TABLES:
            con.execute(f"create view {table} as select * from '{sf}/{table}.parquet'")
        theirs = con.execute(f"select {', '.join(names)} from ({oracle.oracle_sql()[name]})").fetchall()
        got = sorted([tuple(map(plain, r)) for r in mine.select(*names).collect()], key=repr)
        want = sorted([tuple(map(plain, r)) for r in theirs], key=repr)
        assert got == want
        return got
    return compare
