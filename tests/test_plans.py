"""Plan shapes that have to hold at any size."""

import pytest

import __spark_entry__ as contract
from millrace.plans import batch

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    ("name", "exchanges"),
    [
        ("tumble_count_user_1h", 1),
        ("window_argmax_1h", 1),
        ("word_count", 1),
        ("derived_key_sum", 1),
        ("count_window_2", 1),
        ("changelog_count_user", 1),
        ("pattern_match_count", 1),
        ("parsed_lines", 0),
        ("union_all_filtered", 0),
        ("json_decoded", 0),
    ],
)
def test_number_of_shuffles(spark, name, exchanges):
    plan = plan_of(contract.queries()[name](spark, SF_DIR))
    assert plan.count("Exchange hashpartitioning") == exchanges
    assert plan.count("Exchange") == exchanges


@pytest.mark.parametrize(
    ("name", "columns"),
    [
        ("tumble_count_user_1h", "ts:timestamp_ntz,user_id:bigint"),
        ("grouped_count", "event_type:string"),
        ("derived_key_sum", "l_orderkey:bigint,l_linenumber:int"),
        ("word_count", "text:string"),
        ("pattern_match_count", "event_id:bigint,user_id:bigint,event_type:string"),
    ],
)
def test_only_needed_columns_are_read(spark, name, columns):
    df = contract.queries()[name](spark, SF_DIR)
    assert f"ReadSchema: struct<{columns}>" in plan_of(df)


@pytest.mark.parametrize(
    ("name", "pushed"),
    [
        ("filter_group_sum", "EqualTo(o_orderstatus,F)"),
        ("union_all_filtered", "GreaterThan(c_acctbal,5000.0)"),
        ("union_all_filtered", "LessThan(s_acctbal,1000.0)"),
        ("derived_key_sum", "GreaterThanOrEqual(l_orderkey,4)"),
        ("pattern_match_count", "EqualTo(event_type,signup)"),
    ],
)
def test_filters_reach_the_scan(spark, name, pushed):
    assert pushed in plan_of(contract.queries()[name](spark, SF_DIR))


def test_aggregates_are_combined_before_the_shuffle(spark):
    for name in ("tumble_multi_agg_5m", "word_count", "group_sum_having"):
        plan = plan_of(batch.QUERIES[name](spark, SF_DIR))
        assert "partial_" in plan[plan.index("Exchange") :]


def test_no_python_in_table_queries(spark):
    for name, query in batch.QUERIES.items():
        if name in ("edit_size_user_defined", "props_by_row"):
            continue
        plan = plan_of(query(spark, SF_DIR))
        for operator in ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "MapInArrow"):
            assert operator not in plan, name
        assert "CartesianProduct" not in plan, name
        assert "BroadcastNestedLoopJoin" not in plan, name
