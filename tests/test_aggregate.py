"""Grouped aggregates: HAVING forms, null groups, shared single-pass plans."""

import re

import pytest

from conftest import plan_text, rows
from martkit.operators import aggregate, aggregate_many, filter_optional, not_in
from martkit.spec import AggSpec


@pytest.fixture(scope="module")
def sales(spark):
    data = [("a", 1, 10.0), ("a", 2, None), ("b", 3, 5.0), ("b", None, None), (None, 5, 1.0),
            ("c", None, None)]
    return spark.createDataFrame(data, "g STRING, id BIGINT, v DOUBLE")


def test_group_keys_first_and_nulls_grouped(sales):
    out = aggregate(sales, ["g"], ["count(id) AS n", "sum(v) AS s"])
    assert out.columns == ["g", "n", "s"]
    assert rows(out, "g", "n", "s") == [(None, 1, 1.0), ("a", 2, 10.0), ("b", 1, 5.0), ("c", 0, None)]


def test_having_on_aggregate_not_in_output(sales):
    out = aggregate(sales, "g", "sum(v) AS s", having="count(id) > 1")
    assert rows(out, "g", "s") == [("a", 10.0)]


def test_having_on_alias_and_key(sales):
    assert rows(aggregate(sales, ["g"], ["count(id) AS n"], having="n >= 1"), "g") == [
        (None,), ("a",), ("b",)]
    assert rows(aggregate(sales, ["g"], ["count(id) AS n"], having="g = 'b'"), "g", "n") == [("b", 1)]


def test_having_drops_null_sum(sales):
    out = aggregate(sales, ["g"], ["sum(v) AS s"], having="sum(v) <> 0")
    assert ("c",) not in rows(out, "g")


def test_where_and_expression_keys(sales):
    out = aggregate(sales, ["upper(g)"], ["count(1) AS n"], where="id > 1")
    assert out.columns == ["upper(g)", "n"]
    assert rows(out, "upper(g)", "n") == [(None, 1), ("A", 1), ("B", 1)]


def test_empty_having_means_none(sales):
    assert aggregate(sales, ["g"], ["count(1) AS n"], having="  ").count() == 4


def test_aggregate_many_shared_equals_independent(sales):
    specs = [
        AggSpec.of(["g"], ["count(id) AS n"], having="count(id) > 1", name="cnt"),
        AggSpec.of(["g"], ["sum(v) AS s"], having="s <> 0", name="sum"),
        AggSpec.of(["id"], ["max(v) AS mx"], where="v IS NOT NULL", name="by_id"),
        AggSpec.of(["upper(g)"], ["count(1) AS n"], where="id > 1", having="count(1) >= 1", name="up"),
    ]
    out = aggregate_many(sales, specs)
    independent = {k: sorted(map(tuple, out[k].collect()), key=str) for k in out}
    columns = {k: out[k].columns for k in out}
    with out:
        shared = {k: sorted(map(tuple, out[k].collect()), key=str) for k in out}
        assert {k: out[k].columns for k in out} == columns
    assert shared == independent
    assert independent["cnt"] == [("a", 2)]
    assert independent["by_id"] == sorted([(1, 10.0), (3, 5.0), (5, 1.0)], key=str)


def test_shared_plan_reads_input_once(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).selectExpr("id % 7 AS a", "id % 5 AS b", "id AS v").write.parquet(path)
    df = spark.read.parquet(path)
    out = aggregate_many(df, [AggSpec.of(["a"], ["sum(v) AS s"], name="x"),
                              AggSpec.of(["b"], ["count(v) AS c"], where="v > 10", name="y")])
    plan = plan_text(out.combined)
    assert len(re.findall(r"^\(\d+\) Scan parquet", plan, re.M)) == 1
    with out:
        assert out["x"].count() == 7 and out["y"].count() == 5


def test_not_in_drops_null(spark):
    df = spark.createDataFrame([(1,), (2,), (None,), (28856,)], "category_id BIGINT")
    out = filter_optional(df, not_in("category_id", [2, 28856]))
    assert [r[0] for r in out.collect()] == [1]
    assert filter_optional(df, "category_id NOT IN (2, 28856)").count() == 1


def test_shared_equals_independent(spark):
    from martkit.operators.aggregate import aggregate_many
    from martkit.spec import AggSpec
    data = spark.createDataFrame([(1, 0), (1, 5), (2, 2), (None, 0)], "k long, x long")
    specs = [AggSpec.of(["k"], ["sum(10 div x) AS s"], where="x <> 0", name="a"),
             AggSpec.of(["k"], ["count(1) AS n"], having="count(1) > 0", name="b"),
             AggSpec.of([], ["count(x) AS n"], name="c"),
             AggSpec.of(["k"], ["count(x) AS n"], where="x > 1", name="d")]
    for frame in (data, data.limit(0)):
        apart = aggregate_many(frame, specs)
        with aggregate_many(frame, specs) as together:
            for name in together:
                key = lambda t: tuple((v is not None, v) for v in t)
                assert (sorted(map(tuple, together[name].collect()), key=key)
                        == sorted(map(tuple, apart[name].collect()), key=key)), name
