"""Every registered query against its oracle, on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as spark_entry
import check
from workload.registry import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in check.TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = spark_entry.queries()[name](spark, SF_DIR)
    got = df.toPandas()
    assert len(got) > 0
    oracle = spark_entry.oracle_sql().get(name)
    if oracle is None:
        assert name == "approx_distinct_by_dims"
        return
    want = db.sql(oracle).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert check.normal(got) == check.normal(want)


def test_entry(spark):
    assert spark_entry.entry(spark).limit(1).count() == 1
