"""Every registered query next to its SQL oracle, on the smallest data."""

import os

import duckdb
import pytest
from compare import sorted_rows

import __spark_entry__ as registered
from registry.entries import QUERIES
from registry.oracles import ORACLES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for file in os.listdir(SF_DIR):
        connection.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{SF_DIR}/{file}'")
    return connection


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, database, name):
    df = registered.queries()[name](spark, SF_DIR)
    cursor = database.execute(ORACLES[name])
    want = sorted_rows([d[0] for d in cursor.description], cursor.fetchall())
    assert sorted_rows(df.columns, [tuple(r) for r in df.collect()]) == want


def test_entry(spark):
    assert registered.entry(spark).count() == 2
