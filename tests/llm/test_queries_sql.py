"""Registered queries against their SQL, over whole tables."""

import glob
import os

import duckdb
import pytest

from textmill.llm import queries

SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SMALL}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, duck, name):
    frame = queries.QUERIES[name](spark, SMALL)
    columns = sorted(frame.columns)
    plain = lambda table: sorted((tuple(r[c] for c in columns) for r in table.to_pylist()), key=repr)
    got = plain(frame.toArrow())
    assert got and got == plain(duck.sql(queries.SQL[name]).to_arrow_table())
