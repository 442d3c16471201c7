"""Every query of the suite against its SQL on the smallest tables. The optional part has tests of its own."""

import duckdb
import pytest

import __spark_entry__ as contract
from check import TABLES, rows_of
from suite.oracles import ORACLES
from suite.queries import QUERIES

DIRECTORY = contract.SMOKE_DIR


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DIRECTORY}/{table}.parquet'")
    return connection


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    frame = QUERIES[name](spark, DIRECTORY)
    cursor = duck.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(frame.columns)
    assert rows_of(frame.columns, [tuple(r) for r in frame.collect()]) == rows_of(names, cursor.fetchall())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
