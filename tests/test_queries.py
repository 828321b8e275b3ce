"""Every registered query against its SQL counterpart on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as contract
from tools.check import TABLES, rows_of

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, database, name):
    df = QUERIES[name](spark, SF_DIR)
    found = rows_of(df.columns, df.collect())
    if name not in ORACLES:
        assert found
        return
    result = database.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(columns, result.fetchall()) == found


def test_entry(spark):
    assert contract.entry(spark).columns == ["c_custkey", "c_name", "o_orderkey", "o_totalprice", "n_name"]


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)
