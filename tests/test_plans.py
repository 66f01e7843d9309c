"""What the plans of the registered queries must and must not contain."""

import pytest

from tablework.plans import REGISTERED

QUERIES = {name: registered.run for name, registered in REGISTERED.items()}
WITH_PYTHON = {"g2_value_function", "g3_row_function"}
# Queries whose result is a short list the driver made from aggregates.
REPORTS = {"a12_percentiles", "b3_fail_fast_gate", "k6_mode_error", "t2_only_new_files"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - REPORTS))
def test_no_cross_join_and_no_row_wise_python(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text
    if name not in WITH_PYTHON:
        assert "ArrowEvalPython" not in text and "MapInPandas" not in text


@pytest.mark.parametrize("name", ["w1_rolling_mean", "window_ranks", "window_lag_lead"])
def test_windows_run_per_group(spark, sf_dir, name):
    assert "SinglePartition" not in plan(QUERIES[name](spark, sf_dir))


def test_filter_and_columns_reach_the_scan(spark, sf_dir):
    text = plan(QUERIES["s8_parquet_pushdown"](spark, sf_dir))
    assert "GreaterThanOrEqual(l_discount,0.05)" in text
    schema = text.split("ReadSchema: ")[1]
    assert "l_extendedprice" not in schema and "l_tax" not in schema


def test_prefix_is_pushed_down(spark, sf_dir):
    assert "StringStartsWith(p_name,red)" in plan(QUERIES["f4_like_prefix"](spark, sf_dir))


def test_other_partitions_are_not_read(spark, sf_dir):
    text = plan(QUERIES["s15_partition_pruned"](spark, sf_dir))
    filters = text.split("PartitionFilters: [")[1].split("]")[0]
    assert "o_orderstatus" in filters


def test_versions_after_the_wanted_one_are_not_read(spark, sf_dir):
    text = plan(QUERIES["v4_as_of"](spark, sf_dir))
    filters = text.split("PartitionFilters: [")[1].split("]")[0]
    assert "_version" in filters


@pytest.mark.parametrize("name", ["a7_word_count", "a5_several_keys", "segment_report", "v3_snapshot"])
def test_aggregates_combine_before_the_shuffle(spark, sf_dir, name):
    assert "partial_" in plan(QUERIES[name](spark, sf_dir))


@pytest.mark.parametrize("name", ["r7_top_k", "r8_last_rows", "f12_position_slice"])
def test_slices_are_top_n_per_task(spark, sf_dir, name):
    assert "TakeOrderedAndProject" in plan(QUERIES[name](spark, sf_dir))


def test_nested_fields_are_parsed_only_as_needed(spark, sf_dir):
    assert "html" not in plan(QUERIES["x7_substring"](spark, sf_dir))
