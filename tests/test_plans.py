"""The physical plans keep their promises."""

import pytest

import __spark_entry__ as entry
from millrace.operators.cdc import scd2
from millrace.operators.sizing import broadcast_if_small, plan_bytes
from millrace.plans.catalog import Tables
from millrace.plans.queries.common import change_feed


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def t(spark, data):
    return Tables(spark, data)


RUNS = entry.queries()


@pytest.mark.parametrize("name", sorted(RUNS))
def test_no_all_pairs_join(spark, name, data):
    text = plan(RUNS[name](spark, data))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


def test_filters_and_columns_reach_the_scan(spark, data):
    text = RUNS["filter_predicates"](spark, data)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in text and "In(l_returnflag" in text
    assert "l_extendedprice" not in text


def test_history_shuffles_once(t):
    feed = change_feed(t.events)
    history = scd2(feed, ["user_id"], "ts", delete_when="operation = 'DELETE'")
    assert plan(history).count("Exchange") == 1


def test_bucketed_join_has_no_join_shuffle(spark, data):
    text = plan(RUNS["bucketed_join"](spark, data))
    join = text[text.index("SortMergeJoin"):]
    assert "Exchange" not in join


def test_interval_join_is_an_equi_join(spark, data):
    text = plan(RUNS["join_range_interval"](spark, data))
    assert "SortMergeJoin" in text or "HashJoin" in text


def test_sort_merge_and_broadcast(spark, data):
    assert "SortMergeJoin" in plan(RUNS["join_sort_merge"](spark, data))
    assert "BroadcastHashJoin" in plan(RUNS["join_broadcast"](spark, data))


def test_broadcast_only_below_the_limit(t):
    assert plan_bytes(t.nation) < 10_000
    big = broadcast_if_small(t.lineitem, limit=1000)
    assert "ResolvedHint" not in big._jdf.queryExecution().analyzed().toString()
    small = broadcast_if_small(t.nation)
    assert "ResolvedHint" in small._jdf.queryExecution().analyzed().toString()


def test_partition_filter_prunes(spark, data):
    assert "PartitionFilters: [isnotnull(o_orderpriority" in plan(
        RUNS["partition_pruned_read"](spark, data)
    )


def test_row_filter_reaches_the_join_input(spark, data):
    assert "MACHINERY" in plan(RUNS["row_filter_region"](spark, data))
