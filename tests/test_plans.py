"""Physical plans: pruned scans, pushed filters, and nothing that multiplies rows or runs Python row by row."""

import glob
import os
import re

import pytest

import __spark_entry__ as entry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not glob.glob(f"{SF}/*.parquet"), reason="no test tables")
QUERIES = entry.queries()


def plan(spark, name):
    return QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_row_multiplying_join_and_no_row_python(spark, name):
    text = plan(spark, name)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert bad not in text


def test_scans_read_only_what_they_need(spark):
    schemas = lambda name: " ".join(re.findall(r"ReadSchema: [^\n]*", plan(spark, name)))
    assert not re.search("adj_close|dividend|open", schemas("p5_found"))
    assert not re.search("revenues|analyst|ticker", schemas("p6_found"))
    assert "title" not in schemas("p3_found")
    assert not re.search("ticker|primary_exchange|snap_id", schemas("p4_found"))
    assert "l_tax" not in schemas("enrich_left")


def test_filters_reach_the_scan(spark):
    assert "EqualTo(event_type,error)" in plan(spark, "param_filter")
    assert "GreaterThanOrEqual(ts" in plan(spark, "lookback_14d")
    assert "GreaterThan(c_acctbal" in plan(spark, "active_scan")


def test_newest_row_is_a_top_one(spark):
    assert "TakeOrderedAndProject" in plan(spark, "latest_one")
    assert "WindowGroupLimit" in plan(spark, "latest_per_key")


def test_date_parsers_read_every_stored_text(spark):
    rows = entry.queries()["date_parse_stamps"](spark, SF)
    assert rows.count() >= spark.read.parquet(f"{SF}/vendor_stamp.parquet").count() > 9
