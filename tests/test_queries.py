import duckdb
import pytest

import __spark_entry__ as contract
import check

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for table in check.TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(contract.queries()))
def test_query_equals_its_sql(spark, con, name):
    verdict = check.compare(spark, con, FOLDER, name)
    assert verdict.startswith(("equal", "rows only")), verdict


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_every_check_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
