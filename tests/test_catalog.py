"""Every registered query against its check SQL on the smallest sample."""

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, differences

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, duck, name):
    got = entry.queries()[name](spark, SF_DIR).toPandas()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert len(got.columns) > 0
    else:
        assert differences(got, duck.execute(sql).df()) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
