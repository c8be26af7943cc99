"""Physical-plan properties of the registered queries."""

import re

import pytest

from conftest import SF_SMALL, plan_text

from martkit.plans.fixtures import QUERIES


def test_filter_and_projection_reach_the_scan(spark):
    plan = plan_text(QUERIES["join_program"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(l_discount), GreaterThan(l_discount,0.05)" in plan
    assert "Not(In(s_suppkey, [2,28]))" in plan


def test_flagship_reads_only_needed_columns_and_broadcasts_dims(spark):
    plan = plan_text(QUERIES["v3_brand_average"](spark, SF_SMALL))
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint,l_quantity:double,l_discount:double>" in plan
    assert "Not(In(l_suppkey, [2,28]))" in plan  # dimension filter inferred onto the fact scan
    assert len(re.findall(r"^\(\d+\) BroadcastHashJoin", plan, re.M)) == 2
    assert "SortMergeJoin" not in plan
    # eager aggregation: partial + final on the fact by the join keys, then the
    # merge after the joins; a single shuffle in the whole plan
    assert len(re.findall(r"^\(\d+\) HashAggregate", plan, re.M)) == 4
    assert len(re.findall(r"^\(\d+\) Exchange", plan, re.M)) == 1


def test_join_first_shape_has_one_shuffle_too(spark):
    plan = plan_text(QUERIES["v3_brand_average_onepass"](spark, SF_SMALL))
    assert len(re.findall(r"^\(\d+\) Exchange", plan, re.M)) == 1


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_in_any_plan(spark, name):
    if name in ("sink_parquet_gzip", "sink_csv", "src_csv_ids"):
        pytest.skip("writes files while building; covered by the oracle test")
    plan = plan_text(QUERIES[name](spark, SF_SMALL))
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                 "PythonUDF", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan, f"{name}: {node}"


def test_star_split_dims_read_two_columns(spark):
    plan = plan_text(QUERIES["star_split_dim_b"](spark, SF_SMALL))
    assert "ReadSchema: struct<s_suppkey:bigint,s_name:string>" in plan
