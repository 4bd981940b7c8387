"""Every query of the catalogue against the same query in SQL."""

import math
import os
from decimal import Decimal

import duckdb
import pytest

from tickloom.plans import catalogue

FOLDER = os.environ.get("TEST_FOLDER", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="session")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def rows_by_name(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", list(catalogue.queries()))
def test_query(name, spark, duck):
    got = catalogue.queries()[name](spark, FOLDER)
    rows = [tuple(row) for row in got.collect()]
    assert rows
    sql = catalogue.oracle_sql()[name]
    cursor = duck.execute(sql)
    columns = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    assert sorted(got.columns) == sorted(columns)
    assert len(rows) == len(expected)
    assert rows_by_name(got.columns, rows) == rows_by_name(columns, expected)
