"""Every registered query against the same query in a second engine."""

import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as entry_points
from meterline.plans.oracle import oracle_queries
from meterline.plans.queries import all_queries

FOLDER = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "orders", "lineitem")
KINDS = {
    "boolean": "BOOLEAN",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}

QUERIES = all_queries()
ORACLES = oracle_queries()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def bag(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def test_every_query_has_an_oracle_and_is_registered():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLES) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    cursor = duck.execute(ORACLES[name])
    described = {column[0]: str(column[1]) for column in cursor.description}
    assert {column: KINDS[kind] for column, kind in df.dtypes} == described
    want = bag(cursor.fetchall(), list(described))
    got = bag([tuple(row) for row in df.collect()], df.columns)
    assert len(got) == len(want) and got == want


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns[0] == "pickup_date" and df.count() > 1000
