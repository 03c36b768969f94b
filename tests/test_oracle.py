"""Every query with SQL gives the same rows as the SQL; every other query runs and has rows."""

import glob
import os

import pytest
from oracle_check import compare

import __spark_entry__ as entry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not glob.glob(f"{SF}/*.parquet"), reason="no test tables")
QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows_as_sql(spark, name):
    compare(spark, name, QUERIES[name], ORACLE[name], SF)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).columns


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    days = entry.entry(spark).collect()
    assert len(days) == 21
    assert any(r["raw_value"] is None and r["value"] is not None for r in days)
