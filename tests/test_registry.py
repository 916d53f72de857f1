"""The driver's entry points, and a few queries against their SQL twins."""

import os

import duckdb
import pytest

import __spark_entry__ as driver
import check

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the test tables")


def test_every_twin_has_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize(
    "name", ["fact_build", "top_customers_by_orders", "scd2_changes_only", "envelope_quarantine"]
)
def test_query_equals_its_twin(spark, name):
    duck = duckdb.connect()
    for table in check.TABLES:
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    result = driver.queries()[name](spark, SF_DIR)
    cursor = duck.execute(driver.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(result.columns)
    assert check.rows(result.columns, result.collect()) == check.rows(names, cursor.fetchall())


def test_entry_has_rows(spark):
    assert driver.entry(spark).limit(1).count() == 1
