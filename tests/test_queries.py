"""Every registered query against its SQL in DuckDB."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from textmill.registry import oracle, queries

SMALL = "/root/testdata/sf0.001"
QUERIES = queries.QUERIES  # those of optional packages have tests of their own
SQL = oracle.sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SMALL}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def rows(table, columns):
    def plain(value):
        return round(value, 9) if isinstance(value, float) else value

    found = table.select(columns).to_pylist()
    return sorted((tuple(plain(r[c]) for c in columns) for r in found), key=repr)


def test_names():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    frame = QUERIES[name](spark, SMALL)
    columns = sorted(frame.columns)
    got = rows(frame.toArrow(), columns)
    assert got and got == rows(duck.sql(SQL[name]).to_arrow_table(), columns)


def test_flagship(spark):
    report = entry.entry(spark)
    assert report.columns == ["source", "documents", "tokens", "ratio"]
    assert report.filter("source = 'Total'").first().ratio == 100.0
