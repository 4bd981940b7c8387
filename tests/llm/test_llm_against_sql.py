"""Queries of the training-data operators against the same queries in SQL."""

import duckdb
import pytest

from tickloom.llm import catalogue

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in "documents pages benchmark labels conversations".split():
        connection.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(catalogue.oracle_sql()))
def test_query(name, spark, duck):
    got = catalogue.queries()[name](spark, FOLDER)
    columns = sorted(got.columns)
    rows = sorted((tuple(r[c] for c in columns) for r in got.collect()), key=repr)
    cursor = duck.execute(catalogue.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    expected = sorted((tuple(r[names.index(c)] for c in columns) for r in cursor.fetchall()), key=repr)
    assert sorted(names) == columns
    assert rows and rows == expected
