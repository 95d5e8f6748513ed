"""Driver contract, SQL counterparts on the smallest sample, and plans."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from aljibe.operators import joins
from aljibe.plans.catalog import QUERIES
from aljibe.plans.samples import table
from checks import compare
from checks.oracle import ORACLE

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="sample tables not present")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns == ["order_date", "total_orders", "total_revenue", "avg_ticket"]


def test_queries_equal_sql(spark):
    different = compare.differences(spark, FOLDER, list(QUERIES))
    assert different == {}


def test_no_query_leaves_the_jvm_or_pairs_everything(spark):
    for name, query in QUERIES.items():
        text = plan(query(spark, FOLDER))
        for operator in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert operator not in text, (name, operator)


def test_scans_read_only_what_they_need(spark):
    text = plan(entry.queries()["approved_by_group"](spark, FOLDER))
    assert "ReadSchema: struct<o_orderstatus:string,o_totalprice:double,o_orderpriority:string>" in text
    assert "EqualTo(o_orderstatus,F)" in text
    text = plan(entry.queries()["incremental_window"](spark, FOLDER))
    assert "GreaterThan(o_orderdate,1997-01-01" in text and "LessThanOrEqual(o_orderdate," in text


def test_latest_per_key_reduces_before_the_shuffle(spark):
    text = plan(entry.queries()["latest_per_key"](spark, FOLDER))
    assert text.count("WindowGroupLimit") == 2


def test_checks_shuffle_keys_only(spark):
    """The short list of duplicated keys is broadcast; the rows stay where they are. Building the frame runs no job."""
    orders = table(spark, FOLDER, "orders").withColumn("order_id", F.when(F.col("o_orderkey") % 9 > 0, F.col("o_orderkey")))
    before = spark.sparkContext.statusTracker().getJobIdsForGroup()
    text = plan(joins.with_group_size(orders, ["order_id"]))
    assert "BroadcastHashJoin" in text and text.count("Exchange hashpartitioning") == 1
    assert spark.sparkContext.statusTracker().getJobIdsForGroup() == before
