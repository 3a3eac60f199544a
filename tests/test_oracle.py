"""Every query against the same query in DuckDB, value by value."""

import os

import pytest

import __spark_entry__ as entry_points
from encore.fixtures.oracle import ORACLE_SQL
from encore.fixtures.queries import QUERIES
from compare import duckdb_over, duckdb_result, spark_result

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    return duckdb_over(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    types, rows = spark_result(entry_points.queries()[name](spark, SF_DIR))
    sql_types, sql_rows = duckdb_result(duck, entry_points.oracle_sql()[name])
    assert types == sql_types
    assert rows == sql_rows
    assert rows


def test_only_the_model_fits_lack_sql():
    without = set(QUERIES) - set(ORACLE_SQL)
    assert without == {"logreg_scores", "logreg_metrics", "logreg_top_decile_lift"}


def test_entry(spark):
    table = entry_points.entry(spark)
    assert table.count() == 623
    assert len(table.columns) == 10
