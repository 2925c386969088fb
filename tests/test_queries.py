"""Every query against its SQL in DuckDB, on the smallest tables."""

import duckdb
import pytest
from conftest import SF

import __spark_entry__ as entry
from check_oracle import TABLES, rows_of
from contigloom.plans.oracle import ORACLE
from contigloom.plans.queries import QUERIES as DOMAIN_QUERIES

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(DOMAIN_QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    cursor = con.execute(SQL[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, cursor.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
