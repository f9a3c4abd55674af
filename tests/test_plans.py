"""Shapes of physical plans that must hold at any scale."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SF_DIR
from loomframe.sources.tables import table

QUERIES = entry.queries()
def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["where_equals"](spark, SF_DIR))
    assert "EqualTo(o_orderpriority,1-URGENT)" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double,o_orderpriority:string>" in text


def test_global_average_is_pushed_as_a_subquery(spark):
    assert "GreaterThanOrEqual(p_retailprice,ScalarSubquery" in plan(QUERIES["above_average"](spark, SF_DIR))


@pytest.mark.parametrize("name", ["top_k", "span_top5", "top3_by_children", "first_ten_urls"])
def test_top_k_does_not_sort_everything(spark, name):
    assert "TakeOrderedAndProject" in plan(QUERIES[name](spark, SF_DIR))


def test_first_per_key_is_limited_before_the_shuffle(spark):
    text = plan(QUERIES["keep_first"](spark, SF_DIR))
    assert text.count("WindowGroupLimit") == 2


def test_children_are_folded_before_joins(spark):
    text = plan(QUERIES["cost_by_parent"](spark, SF_DIR))
    assert text.rindex("partial_sum") > text.rindex("Join") and text.count("partial_sum") >= 2


def test_profit_view_reads_each_child_once(spark):
    assert plan(QUERIES["profit_view"](spark, SF_DIR)).count("FileScan") == 3


def test_argmax_counts_groups_once_at_run_time(spark):
    df = QUERIES["argmax_groups"](spark, SF_DIR)
    df.collect()
    assert "ReusedExchange" in plan(df)


def test_quantiles_fold_before_shuffling(spark):
    from loomframe.operators.quantiles import group_cells

    df = table(spark, SF_DIR, "lineitem").select(F.col("l_extendedprice").alias("__x"))
    text = plan(group_cells(df, [], (0.5,), 10_000))
    assert "partial_percentile" in text and "partial_count" in text
