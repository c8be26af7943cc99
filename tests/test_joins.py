"""Join semantics: USING layout, every join type, null keys, guards, salting, broadcast probe."""

import pytest
from pyspark.errors import PySparkException

from conftest import plan_text, rows
from martkit.operators import broadcast_if_bounded, join_program, join_using
from martkit.operators.joins import Table
from martkit.spec import JoinStep


@pytest.fixture(scope="module")
def sides(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n"), (4, "d"), (4, "d2")],
                                 "k BIGINT, lv STRING")
    right = spark.createDataFrame([(1, "x"), (3, "y"), (None, "m"), (4, "z")],
                                  "k BIGINT, rv STRING")
    return left, right


def test_layout_key_first(sides):
    left, right = sides
    assert join_using(left, right, "k").columns == ["k", "lv", "rv"]


@pytest.mark.parametrize("how,expected", [
    ("inner", [(1, "a", "x"), (4, "d", "z"), (4, "d2", "z")]),
    ("left", [(None, "n", None), (1, "a", "x"), (2, "b", None), (4, "d", "z"), (4, "d2", "z")]),
    ("right", [(None, None, "m"), (1, "a", "x"), (3, None, "y"), (4, "d", "z"), (4, "d2", "z")]),
    ("full", [(None, None, "m"), (None, "n", None), (1, "a", "x"), (2, "b", None), (3, None, "y"),
              (4, "d", "z"), (4, "d2", "z")]),
    ("cross", [(1, "a", "x"), (4, "d", "z"), (4, "d2", "z")]),
])
def test_outer_and_inner(sides, how, expected):
    left, right = sides
    assert rows(join_using(left, right, "k", how), "k", "lv", "rv") == expected


@pytest.mark.parametrize("how,expected", [
    ("semi", [(1, "a"), (4, "d"), (4, "d2")]),
    ("left_anti", [(None, "n"), (2, "b")]),
])
def test_semi_anti(sides, how, expected):
    left, right = sides
    out = join_using(left, right, "k", how)
    assert out.columns == ["k", "lv"]
    assert rows(out, "k", "lv") == expected


def test_filters_apply_before_join(sides):
    left, right = sides
    out = join_using(left, right, "k", "left", left_filter="lv <> 'b'", right_filter="rv = 'z'")
    assert rows(out, "k", "lv", "rv") == [(None, "n", None), (1, "a", None), (4, "d", "z"), (4, "d2", "z")]


def test_unknown_type_and_keyless_are_refused(sides):
    left, right = sides
    with pytest.raises(ValueError):
        join_using(left, right, "k", "sideways")
    with pytest.raises(ValueError):
        join_using(left, right, "", "cross")


def test_shared_non_key_column_is_named(spark):
    a = spark.createDataFrame([(1, "p")], "k BIGINT, name STRING")
    b = spark.createDataFrame([(1, "q")], "k BIGINT, name STRING")
    with pytest.raises(ValueError, match="name"):
        join_using(a, b, "k")
    assert join_using(a, b, "k", "left_semi").count() == 1


def test_missing_key_is_named(sides):
    left, right = sides
    with pytest.raises(ValueError, match="zz"):
        join_using(left, right, "zz")


def test_program_indexing_and_empty_steps(spark, sides):
    left, right = sides
    third = spark.createDataFrame([(1, 10), (4, 40)], "k BIGINT, w INT")
    out = join_program([Table(left, "lv <> 'd2'"), right, third],
                       [JoinStep(0, 1, "k"), "3 2 k inner"])
    assert rows(out, "k", "lv", "rv", "w") == [(1, "a", "x", 10), (4, "d", "z", 40)]
    assert join_program([left, right], []) is right
    with pytest.raises(IndexError):
        join_program([left, right], ["0 5 k"])


def test_salted_join_matches_plain(spark):
    big = spark.range(0, 20000).selectExpr("CASE WHEN id % 3 = 0 THEN 1 ELSE id % 50 END AS k",
                                           "id AS v")
    dim = spark.range(0, 50).selectExpr("id AS k", "concat('n', id) AS name")
    # Keys 50..59 of the dimension have no fact rows: the right/full cases.
    dim = spark.range(0, 60).selectExpr("id AS k", "concat('n', id) AS name")
    for how in ("inner", "left", "right", "full", "left_semi", "left_anti"):
        plain = join_using(big, dim, "k", how)
        salted = join_using(big, dim, "k", how, salt_buckets=8)
        assert salted.columns == plain.columns, how
        assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, salted.collect())), how
    assert join_using(big, dim, "k", salt_buckets=8).columns == ["k", "v", "name"]
    # Columns xxhash64 refuses (maps, variants) are left out of the salt.
    odd = big.selectExpr("k", "v", "map('a', v) AS m", "parse_json(CAST(v AS STRING)) AS j")
    got = join_using(odd, dim, "k", salt_buckets=8).select("k", "v", "name")
    assert sorted(map(tuple, got.collect())) == sorted(
        map(tuple, join_using(big, dim, "k").collect()))
    # The key resolves case-insensitively, as in Spark's own USING join.
    upper = dim.withColumnRenamed("k", "K")
    for how in ("inner", "left", "right", "full"):
        plain = join_using(big, upper, "K", how)
        salted = join_using(big, upper, "K", how, salt_buckets=8)
        assert [c.lower() for c in salted.columns] == [c.lower() for c in plain.columns], how
        assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, salted.collect())), how


def test_broadcast_only_within_bounds(spark):
    small = spark.range(10)
    _, ok = broadcast_if_bounded(small, max_rows=100)
    assert ok
    _, ok = broadcast_if_bounded(spark.range(1000), max_rows=100)
    assert not ok
    _, ok = broadcast_if_bounded(small, max_rows=100, max_bytes=10)
    assert not ok


def test_probe_sends_one_row_per_task(spark):
    from martkit.operators.joins import probe_frame
    side = spark.range(0, 5000, numPartitions=8).selectExpr("id AS k", "concat('n', id) AS name")
    plan = plan_text(probe_frame(side))
    assert "Limit" not in plan and "partial_count" in plan and "partial_sum" in plan
    row = probe_frame(side).first()
    assert row["n"] == 5000 and row["b"] > 5000 * 16


def test_broadcast_hint_reaches_plan(spark, sides):
    left, right = sides
    plan = plan_text(join_using(left, right, "k", broadcast="right"))
    assert "BroadcastHashJoin" in plan


def test_unknown_join_type_at_runtime_is_error_free(sides):
    left, right = sides
    with pytest.raises((ValueError, PySparkException)):
        join_using(left, right, "k", "natural")


def test_huge_side_is_declined_without_a_probe(spark, monkeypatch):
    import martkit.operators.joins as j
    big = spark.range(10)
    monkeypatch.setattr(j, "estimated_bytes", lambda df: 10 * 2**40)  # pretend 10 TiB

    def no_probe(*a, **k):
        raise AssertionError("probe must not run")
    monkeypatch.setattr(j, "_probe", no_probe)
    _, ok = j.broadcast_if_bounded(big)
    assert not ok


def test_grown_file_is_probed_again(spark, tmp_path):
    from martkit.operators.joins import broadcast_if_bounded
    path = str(tmp_path / "dim")
    for n, want in ((10, True), (100_000, False), (10, True)):
        spark.range(n).write.mode("overwrite").parquet(path)
        assert broadcast_if_bounded(spark.read.parquet(path), max_rows=100)[1] is want


def test_joined_sizes_are_estimates_however_large(spark):
    from martkit.operators.joins import estimated_bytes
    line = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet").select("l_partkey")
    big = line.join(line, "l_partkey").join(line, "l_partkey")
    assert estimated_bytes(big) > 10**15
    assert estimated_bytes(spark.range(3).rdd.toDF()) is None


def test_salted_join_on_dotted_names(spark):
    left = spark.createDataFrame([(1, 2), (1, 3), (4, 5)], "`k.x` long, `a.b` long")
    right = spark.createDataFrame([(1, "u")], "`k.x` long, `c.d` string")
    for how in ("inner", "left"):
        got = join_using(left, right, "k.x", how, salt_buckets=4) if how == "inner" else None
        if got is not None:
            assert sorted(map(tuple, got.collect())) == [(1, 2, "u"), (1, 3, "u")]


def test_estimate_is_read_from_the_plan(spark):
    from martkit.operators.joins import estimated_bytes
    est = estimated_bytes(spark.read.parquet("/root/testdata/sf0.01/part.parquet"))
    assert est is not None and est > 1000


def test_salted_join_never_broadcasts_the_copied_side(spark):
    left = spark.range(1000).selectExpr("id % 50 AS k", "id AS v")
    right = spark.range(50).selectExpr("id AS k", "concat('n', id) AS name")
    for how in ("inner", "left", "left_semi", "left_anti"):
        plan = plan_text(join_using(left, right, "k", how, salt_buckets=4, hot="all"))
        assert "SortMergeJoin" in plan and "Broadcast" not in plan, how
