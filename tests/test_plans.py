"""Physical plans: what reaches the scan, what is shuffled, what is reduced before."""

import itertools
import re

import pytest
from pyspark.sql import functions as F

from tidewell.catalog.queries import QUERIES
from tidewell.operators import dedup, visits
from tidewell.sources import dims


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(text):
    return re.findall(r"FileScan parquet .*?ReadSchema: (\S+)", text)


def test_projection_of_one_table_reads_one_file(spark, small):
    text = plan(QUERIES["cdc_project_order"](spark, small))
    assert len(scans(text)) == 1 and "o_orderpriority" not in scans(text)[0]
    assert "Exchange" not in text


def test_routing_reads_configured_tables_only(spark, small):
    assert len(scans(plan(QUERIES["dim_column_prune"](spark, small)))) == 2


def test_fact_join_reads_needed_columns(spark, small):
    text = plan(QUERIES["dwd_order_refund"](spark, small))
    assert len(scans(text)) == 2
    assert "l_tax" not in text and "EqualTo(l_returnflag,R)" in text
    assert "o_totalprice" not in text and "struct(" not in text


def test_point_lookup_reaches_the_scan(spark, small, tmp_path):
    path = str(tmp_path / "dim")
    dims.as_dim(spark.read.parquet(f"{small}/supplier.parquet"), "s_suppkey", {"s_name": "name"}).write.parquet(path)
    assert "EqualTo(row_key,7)" in plan(dims.get_row(spark.read.parquet(path), "7"))


def test_queries_read_no_more_than_they_look_up(spark, small):
    assert "EqualTo(s_suppkey,7)" in plan(QUERIES["dim_point_lookup"](spark, small))
    assert len(scans(plan(QUERIES["job_dim_load"](spark, small)))) == 1


def test_latest_is_cut_before_the_shuffle(spark, small):
    text = plan(QUERIES["dedup_latest"](spark, small))
    partial = text.rindex("WindowGroupLimit")
    assert text.count("WindowGroupLimit") == 2 and partial > text.index("Exchange hashpartitioning")


@pytest.mark.parametrize("name", ["dws_home_detail_uv", "dws_user_login", "dws_cart_add_uu", "dws_traffic_page_view"])
def test_no_window_over_raw_rows(spark, small, name):
    """First rows per day are found by aggregates that reduce before their shuffle."""
    text = plan(QUERIES[name](spark, small))
    assert "partial_min" in text
    for block in text.split("Window [")[1:]:
        assert "partial_min" in block


def test_new_visitor_repair_has_no_window(spark, small):
    assert "Window" not in plan(QUERIES["fix_is_new"](spark, small))


def test_interval_join_is_no_nested_loop(spark, small):
    text = plan(QUERIES["interval_join_user"](spark, small))
    assert "NestedLoop" not in text and "Cartesian" not in text and "_slice" in text


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_and_no_python_rows(spark, small, name):
    text = plan(QUERIES[name](spark, small))
    for bad in ("NestedLoop", "Cartesian", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas"):
        assert bad not in text
    assert ("MapInPandas" in text) == (name == "dedup_bloom")


def test_lookup_beyond_the_broadcast_limit_is_shuffled(spark, small):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = QUERIES["dim_join_province"](spark, small)
        assert "SortMergeJoin" in plan(df) and df.count() > 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_key(spark):
    """One key with a third of the rows: results hold and its rows are reduced where they are read."""
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        (F.col("id") * 1000).alias("ts"),
        "id",
    )
    firsts = visits.first_of_day(df, ["k"], "ts", ["id"], ["id"])
    assert firsts.filter("k = 'hot'").count() == 1
    retracted = dedup.retract(df.withColumn("amount", F.lit(1)), "k", ["id"], ["amount"])
    assert retracted.count() == 30_000 + 9_999
    assert dedup.latest(df, ["k"], ["id"]).filter("k = 'hot'").first().id == 29_997


@pytest.mark.parametrize("name, times", [("dwd_order_detail", 1), ("dwd_pay_success", 2), ("dwd_order_cancel", 2)])
def test_order_lines_are_shuffled_once(spark, small, name, times):
    """Whole lines are shuffled for all joins of the fact together, and then only those of the orders asked for."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = plan(QUERIES[name](spark, small))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    lines = text.splitlines()
    wide = 0
    for i, line in enumerate(lines):
        if " Exchange " in line:
            below = next(x for x in lines[i + 1 :] if "Project" in x)
            wide += "AS sku_name#" in below or " sku_name#" in below
    assert wide == times
    if times == 2:
        semi = next(i for i, x in enumerate(lines) if "LeftSemi" in x)
        under = itertools.takewhile(lambda x: re.search(r"\w", x).start() > re.search(r"\w", lines[semi]).start(), lines[semi + 1 :])
        assert "l_orderkey" not in "".join(under)
