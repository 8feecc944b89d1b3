"""Registered queries against their SQL on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from check_oracle import TABLES, rows_of

SF = Path("/root/testdata/sf0.001")
QUERIES, ORACLE = entry.queries(), entry.oracle_sql()
SLOW = {"bagging_knn", "compare_classifiers"}

pytestmark = pytest.mark.skipif(not SF.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF / name}.parquet'")
    return connection


@pytest.mark.parametrize("name", [n for n in ORACLE if n not in SLOW])
def test_query_equals_sql(spark, db, name):
    df = QUERIES[name](spark, str(SF))
    theirs = db.sql(ORACLE[name])
    assert sorted(df.columns) == sorted(theirs.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(theirs.columns, theirs.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
