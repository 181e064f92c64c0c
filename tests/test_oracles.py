"""Every registered query against DuckDB on the same tables."""

import math

import duckdb
import pytest

import __spark_entry__ as contract
from lumenlake.registry import oracles
from lumenlake.registry.queries import registered

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()
QUERIES, ORACLES = registered(), oracles.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    return connection


def shown(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    return value


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_duckdb(spark, duck, name):
    found = QUERIES[name](spark, SF)
    rows = found.collect()
    cursor = duck.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(found.columns)
    order = sorted(names)
    expected = [tuple(shown(row[names.index(c)]) for c in order) for row in cursor.fetchall()]
    actual = [tuple(shown(row[c]) for c in order) for row in rows]
    assert sorted(actual, key=repr) == sorted(expected, key=repr)


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0
