"""Shape of the physical plans."""

import os
import re

import pytest
from pyspark.sql import functions as F

from modelkit.functions import skew
from modelkit.operators import dedupe, matches
from modelkit.plans.queries import QUERIES
from modelkit.session import settings
from modelkit.sources import tables

FOLDER = f"{os.environ.get('TESTDATA', '/root/testdata')}/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables not present")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pairing_without_keys_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    for operator in ("CartesianProduct", "NestedLoopJoin", "PythonUDF", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
        assert operator not in text


def test_large_sides_are_not_broadcast(spark):
    """With the size limit at zero every join still has a shuffled plan."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    orders = tables.read_table(spark, FOLDER, "orders")
    customers = tables.read_table(spark, FOLDER, "customer").withColumnRenamed("c_custkey", "o_custkey")
    assert skew.checked_broadcast(customers, 0) is customers
    joined = plan(orders.join(skew.checked_broadcast(customers, 0), "o_custkey"))
    assert "SortMergeJoin" in joined and "BroadcastHashJoin" not in joined
    assert "BroadcastHashJoin" in plan(orders.join(skew.checked_broadcast(customers), "o_custkey"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")


def test_bucketed_join_has_no_shuffle(spark, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    orders = tables.read_table(spark, FOLDER, "orders").select(F.col("o_orderkey").alias("k"), "o_orderpriority")
    lines = tables.read_table(spark, FOLDER, "lineitem").select(F.col("l_orderkey").alias("k"), "l_quantity")
    tables.write_bucketed(orders, "plan_orders", "k", path=str(tmp_path / "o"))
    tables.write_bucketed(lines, "plan_lines", "k", path=str(tmp_path / "l"), files_per_bucket=2)
    tables.write_bucketed(lines.groupBy("k").count(), "plan_counts", "k", path=str(tmp_path / "c"))
    names = ["plan_lines", "plan_orders", "plan_counts"]
    joined = matches.bucketed_join(spark, names, "k")
    text = plan(joined)
    assert "SortMergeJoin" in text and "Exchange" not in text
    assert joined.count() == lines.count()
    loose = plan(lines.join(orders, "k"))
    assert len(re.findall("Exchange hashpartitioning", loose)) == 2
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")


def test_salted_join_only_broadcasts_hot_keys(spark):
    lines = tables.read_table(spark, FOLDER, "lineitem").select(F.col("l_orderkey").alias("k"), "l_partkey")
    orders = tables.read_table(spark, FOLDER, "orders").select(F.col("o_orderkey").alias("k"), "o_orderpriority")
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        text = plan(skew.salted_join(lines, orders, ["k"], ["l_partkey"], max_bytes=0))
    assert text.count("SortMergeJoin") == 1 and text.count("BroadcastHashJoin") == 2
    assert "NestedLoop" not in text and "__salt" in text.split("SortMergeJoin")[1].splitlines()[0]
    counted = text.split("BroadcastExchange")[1]
    assert "partial_count" in counted and "ReadSchema: struct<l_orderkey:bigint>" in counted


def test_dedupe_limits_groups_before_the_shuffle(spark):
    lines = tables.read_table(spark, FOLDER, "lineitem")
    text = plan(dedupe.dedupe(lines, ["l_orderkey"], ["l_linenumber", "l_partkey"]))
    before = text.split("Exchange", 1)[1]
    assert "WindowGroupLimit" in before and "Partial" in before


def test_pruning_reaches_the_scan(spark, tmp_path):
    orders = tables.read_table(spark, FOLDER, "orders").withColumn("year", F.year("o_orderdate"))
    tables.write_period(orders, str(tmp_path / "orders"), "year")
    one = spark.read.parquet(str(tmp_path / "orders")).where(F.col("year") == 1997).select("o_custkey")
    text = plan(one)
    assert re.search(r"PartitionFilters: \[[^\]]*year", text) and "ReadSchema: struct<o_custkey:bigint>" in text


def test_daily_filter_is_pushed_down(spark):
    import datetime as dt

    from modelkit.operators.datelist import active_on

    events = tables.read_table(spark, FOLDER, "events")
    text = plan(active_on(events, ["user_id"], "ts", dt.date(2024, 1, 3)))
    assert "PushedFilters: [" in text and "GreaterThanOrEqual(ts" in text and "LessThan(ts" in text


def test_backfills_read_their_source_once(spark):
    for name in ("user_datelist", "growth_accounting", "array_metric", "host_reduced"):
        assert plan(QUERIES[name](spark, FOLDER)).count("FileScan") == 1


def test_graph_totals_do_not_pair_members(spark):
    """Every join is with sums or lists of one row per key, not of a group with itself."""
    text = plan(QUERIES["graph_tie_totals"](spark, FOLDER))
    assert "Generate" not in text.split("SortMergeJoin")[0]


def test_vertices_read_details_once(spark):
    assert plan(QUERIES["graph_max_points"](spark, FOLDER)).count("FileScan") == 1
