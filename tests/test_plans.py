"""Shapes the physical plans must keep."""

from __future__ import annotations

import re

import pytest

from shelfwise.plans import registry


QUERIES = registry.queries()
PYTHON_QUERIES = ("csv_", "store_page_records", "crawl_", "fix_encoding", "clean_catalog", "model_", "missing_by", "unknown_by", "step_retention")


def plan_of(spark, folder, name):
    return QUERIES[name](spark, folder)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pairwise_joins_and_no_row_at_a_time_python(spark, small, name):
    plan = plan_of(spark, small, name)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan
    if not name.startswith(PYTHON_QUERIES):
        assert "Python" not in plan and "MapInArrow" not in plan


@pytest.mark.parametrize("name", ["url_dedup", "seen_dedup", "smart_dedup", "bq5_platform_pricing"])
def test_hot_groups_are_pruned_before_the_shuffle(spark, small, name):
    plan = plan_of(spark, small, name)
    assert re.search(r"WindowGroupLimit .*Partial", plan)


@pytest.mark.parametrize("name", ["bq1_top_rated", "bq2_top_performers", "bq4_consistent_publishers", "top_rated_games", "rating_gap"])
def test_top_rows_are_taken_per_task(spark, small, name):
    assert "TakeOrderedAndProject" in plan_of(spark, small, name)


def test_reports_scan_their_input_once(spark, small):
    plan = plan_of(spark, small, "field_completeness")
    assert plan.count("rating_raw") and plan.count("Scan parquet") == 2  # listing and dates


def test_scans_read_needed_columns_only(spark, small):
    plan = plan_of(spark, small, "bq4_consistent_publishers")
    assert "p_name" not in plan and "l_extendedprice" not in plan and "s_acctbal" not in plan


def test_bucketed_games_and_links_meet_without_a_shuffle(spark, small):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(spark, small, "bucketed_genre_price")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin [game_id" in plan or "SortMergeJoin [id" in plan or "ShuffledHashJoin" in plan
    assert not re.search(r"Exchange hashpartitioning\((game_id|id)#", plan)
