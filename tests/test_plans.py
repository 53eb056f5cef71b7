"""The plans that make a query scale, asserted on registered queries."""

import pytest
from plan_asserts import exchanges, initial_plan, joins, pushed, read_schemas

from etlkit.queries import QUERIES


@pytest.fixture
def plan(spark, sf):
    return lambda name: initial_plan(QUERIES[name](spark, sf))


def test_projection_reads_two_columns(plan):
    assert read_schemas(plan("project_narrow")) == ["p_partkey:bigint,p_retailprice:double"]


def test_filter_on_a_stored_column_is_pushed(plan):
    assert "GreaterThan(p_retailprice,900.0)" in pushed(plan("filter_derived"))[0]


def test_random_filter_is_not_pushed(plan):
    assert pushed(plan("filter_random")) == [""]


def test_constant_false_is_removed(plan):
    text = plan("filter_constant")
    assert text.count("FileScan") == 1


def test_filter_written_after_a_join_lands_in_both_scans(plan):
    text = " ".join(pushed(plan("filter_join_pushdown")))
    assert "GreaterThan(o_totalprice,300000.0)" in text and "GreaterThan(c_acctbal,0.0)" in text


def test_partition_filter_prunes_folders(plan):
    text = plan("partition_pruned_scan")
    assert "PartitionFilters: [isnotnull(o_orderpriority" in text and pushed(text) == [""]


def test_top_k_does_not_sort_everything(plan):
    text = plan("top_k")
    assert "TakeOrderedAndProject" in text and exchanges(text) == 0


def test_aggregates_combine_before_the_shuffle(plan):
    for name in ("agg_basic", "group_count", "counts_one_pass"):
        assert "partial_count" in plan(name), name


def test_key_layout_is_shared_by_the_first_aggregate(plan):
    assert exchanges(plan("layout_by_key")) == 2


def test_plain_window_shares_the_layout_of_its_key(spark, tables):
    from pyspark.sql import Window, functions as F
    window = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    ranked = tables("orders").repartition(8, "o_custkey").withColumn("n", F.row_number().over(window))
    assert exchanges(initial_plan(ranked)) == 1


def test_data_quality_scans_one_column_per_branch(plan):
    assert all("," not in schema for schema in read_schemas(plan("distinct_counts")))


def test_no_query_uses_a_cross_join(spark, sf):
    from etlkit.plans.run_log import join_operators
    for name in QUERIES:
        if name.startswith("join_") or name.startswith("diamond_"):
            used = set(join_operators(initial_plan(QUERIES[name](spark, sf))))
            assert not used & {"CartesianProduct", "BroadcastNestedLoopJoin"}, name


def test_flagship_reads_only_what_it_needs(plan):
    text = plan("flagship_revenue")
    assert joins(text) == ["BroadcastHashJoin"]
    assert "GreaterThan(l_quantity,10.0)" in " ".join(pushed(text))
    assert all("l_shipdate" not in s for s in read_schemas(text))


def test_global_sort_is_one_range_shuffle(plan):
    text = plan("sort_global")
    assert "rangepartitioning(o_orderstatus" in text and exchanges(text) == 1
    assert "o_orderkey" in text.split("rangepartitioning(")[1].split(")")[0]


def test_ordered_windows_shuffle_the_data_once(spark, tables):
    from etlkit.operators.windows import forward_fill, number_rows
    events = tables("events").select("event_id", "ts", "user_id", "value")
    for share, most in ((2.0, 1), (0.0001, 3)):
        filled = forward_fill(events, ["value"], ["user_id"], ["ts", "event_id"], share=share)
        numbered = number_rows(events, ["user_id"], ["ts", "event_id"], share=share)
        for df in (filled, numbered):
            text = initial_plan(df)
            # Hot keys bring their chunk borders along by a broadcast of a small table.
            assert exchanges(text) <= most and set(joins(text)) <= ({"BroadcastHashJoin"} if most > 1 else set())


def test_coalesce_adds_no_shuffle(plan):
    assert exchanges(plan("layout_coalesce")) == exchanges(plan("layout_round_robin")) == 2


def test_first_and_last_duplicates_combine_before_the_shuffle(plan):
    for name in ("dedup_keep_first", "dedup_keep_last", "apply_changes"):
        text = plan(name)
        assert "partial_min_by" in text or "partial_max_by" in text
        assert "Window" not in text


def test_approximate_quality_report_is_one_pass(tables):
    from etlkit.operators.quality import check_data_quality
    text = initial_plan(check_data_quality(tables("orders"), approximate=True))
    assert text.count("FileScan") == 1 and exchanges(text) == 2
    assert "partial_hll_sketch_agg" in text and "partial_hll_union_agg" in text


def test_one_pass_diamond_reads_the_fact_once(plan):
    assert plan("diamond_one_pass").count("l_extendedprice:double") == 1
