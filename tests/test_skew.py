"""A key holding a third of the fact rows: AQE splits it, salting spreads it,
partial aggregation collapses it — and results stay whole."""

import re

import pytest

from conftest import plan_text
from pyspark.sql import functions as F

from martkit.operators import aggregate, join_using
from martkit.operators.joins import reduce_by_keys, salt_column


@pytest.fixture()
def hot(spark):
    # 30,000 fact rows; key 7 holds a third of them.
    fact = spark.range(30000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 7 ELSE id % 1000 END AS k", "id AS v")
    dim = spark.range(1000).selectExpr("id AS k", "concat('name-', id) AS name")
    return fact, dim


def test_aqe_splits_the_hot_partition(spark, hot):
    fact, dim = hot
    conf = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        joined = join_using(fact, dim, "k")  # no broadcast: a shuffle join
        assert len(joined.collect()) == 30000  # runs this plan; explain then shows the final one
        final = plan_text(joined)
        assert "SortMergeJoin" in final
        assert "isSkewJoin=true" in final or "skew=true" in final.lower()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_salted_hot_key_keeps_every_row(hot):
    fact, dim = hot
    plain = join_using(fact, dim, "k").groupBy("name").count()
    salted = join_using(fact, dim, "k", salt_buckets=16).groupBy("name").count()
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, salted.collect()))
    assert dict(map(tuple, salted.collect()))["name-7"] == 10000 + 20  # plus ids with id % 1000 == 7 and id % 3 != 0


def test_hot_group_is_pre_aggregated(hot):
    fact, _ = hot
    out = aggregate(fact, ["k"], ["count(v) AS n", "sum(v) AS s"])
    plan = plan_text(out)
    assert "partial_count" in plan and "partial_sum" in plan
    assert dict((r.k, r.n) for r in out.collect())[7] == 10000 + 20  # plus ids with id % 1000 == 7 and id % 3 != 0


def test_identical_copies_spread_over_buckets(spark):
    # A third of the rows are one identical row (k=7, v=0), read in 8 splits.
    fact = spark.range(0, 30000, numPartitions=8).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 7 ELSE id % 1000 END AS k",
        "CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS v")
    copies = fact.filter("k = 7 AND v = 0").select(salt_column(fact, 16).alias("b"))
    per_bucket = [r["count"] for r in copies.groupBy("b").count().collect()]
    assert sum(per_bucket) == 10000
    assert len(per_bucket) >= 6 and max(per_bucket) <= 10000 / 3
    # Same buckets when the rows are computed again (a retried task).
    again = fact.filter("k = 7 AND v = 0").select(salt_column(fact, 16).alias("b"))
    assert sorted(map(tuple, again.groupBy("b").count().collect())) == sorted(
        map(tuple, copies.groupBy("b").count().collect()))
    dim = spark.range(1000).selectExpr("id AS k", "concat('name-', id) AS name")
    for how in ("inner", "full"):
        salted = join_using(fact, dim, "k", how, salt_buckets=16)
        got = salted.groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("s"))
        want = join_using(fact, dim, "k", how).groupBy("name").agg(
            F.count(F.lit(1)).alias("n"), F.sum("v").alias("s"))
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())), how


def test_pipeline_with_a_hot_brand_and_shuffle_joins(spark):
    from collections import Counter

    from martkit.plans import REFERENCE, pipeline_v3
    # Brand 7 holds a third of the facts; dimensions are joined by shuffle.
    product = spark.range(0, 30000, numPartitions=8).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 7 ELSE id % 100 END AS brand_id",
        "id % 10 AS category_id", "CAST(id % 40 AS BIGINT) AS discount_rate",
        "CAST(id % 6 AS DOUBLE) AS rating_average", "id % 4 AS reviews_count")
    brand = spark.range(100).selectExpr("id AS brand_id", "concat('b', id) AS brand_name")
    category = spark.range(10).selectExpr("id AS category_id", "concat('c', id) AS category_name")
    roles = REFERENCE.with_(broadcast_dims=False, category_filter="category_id <> 2")
    eager = pipeline_v3(product, brand, category, roles)
    first = pipeline_v3(product, brand, category, roles.with_(eager=False))
    plan = plan_text(eager["agg_brand_average_rate"])
    assert "partial_sum" in plan and "partial_count" in plan  # fact reduced before it moves
    for name in eager:
        got = Counter(tuple(r) for r in eager[name].collect())
        assert got == Counter(tuple(r) for r in first[name].collect()), name
    counts = {r.category_id: r.number_of_products for r in eager["agg_products_each_category"].collect()}
    want = Counter(i % 10 for i in range(30000) if i % 40 > 10 and i % 10 != 2)
    assert counts == dict(want)


def test_hot_keys_are_detected_in_one_pass(hot):
    from martkit.operators.joins import hot_keys
    fact, _ = hot
    assert hot_keys(fact, "k") == [7]          # a third of the rows
    assert hot_keys(fact, "k", min_share=0.5) == []
    fifty = fact.selectExpr("v % 50 AS k")      # 50 keys of 2 %
    assert sorted(hot_keys(fifty, "k")) == list(range(50))


def test_selective_salting_keeps_every_row(spark, hot):
    fact, dim = hot
    # nulls on the left (never matched) and right keys without fact rows
    fact = fact.union(spark.range(50).selectExpr("CAST(NULL AS BIGINT) AS k", "id AS v"))
    dim = dim.union(spark.range(1000, 1010).selectExpr("id AS k", "concat('name-', id) AS name"))
    for how in ("inner", "left", "right", "full", "left_semi", "left_anti"):
        want = sorted(map(tuple, join_using(fact, dim, "k", how).collect()),
                      key=lambda t: tuple((v is None, v) for v in t))
        for hot_keys in ([7], "auto", [], [7, 12345678], "all"):
            got = join_using(fact, dim, "k", how, salt_buckets=8, hot=hot_keys)
            got = sorted(map(tuple, got.collect()), key=lambda t: tuple((v is None, v) for v in t))
            assert got == want, (how, hot_keys)


def test_only_hot_keys_are_replicated(spark, hot):
    from martkit.operators.joins import _SALT, salt_sides
    fact, dim = hot
    left, right = salt_sides(fact, dim, "k", 8, hot=[7])
    assert right.count() == 1000 + 7          # key 7 in all 8 buckets, the rest once
    hot_buckets = left.filter("k = 7").select(_SALT).distinct().count()
    assert hot_buckets == 8                     # the hot key is spread
    assert left.filter("k <> 7").select(_SALT).distinct().collect()[0][0] == 0
    _, everything = salt_sides(fact, dim, "k", 8)
    assert everything.count() == 8 * 1000       # default: the whole right side 8 times


def _files(spark, tmp_path, n=40_000):
    """A fact in files (a third of it key 7) and a dimension that lacks and adds keys."""
    spark.range(0, n, numPartitions=4).selectExpr(
        "id AS rid", "CASE WHEN id % 3 = 0 THEN 7 ELSE id % 1000 END AS k", "0 AS v",
        "concat('payload-', id) AS wide").write.parquet(str(tmp_path / "fact"))
    spark.range(500, 1500).selectExpr("id AS k", "concat('name-', id) AS name").union(
        spark.range(7, 8).selectExpr("id AS k", "'seven' AS name")).write.parquet(
        str(tmp_path / "dim"))
    return spark.read.parquet(str(tmp_path / "fact")), spark.read.parquet(str(tmp_path / "dim"))


def test_split_join_copies_nothing_and_prunes(spark, tmp_path):
    fact, dim = _files(spark, tmp_path)
    joined = join_using(fact, dim, "k", salt_buckets=8)
    plan = plan_text(joined.groupBy().count())
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" in plan
    assert "Generate" not in plan  # no row is copied per bucket
    reads = re.findall(r"ReadSchema: struct<(.*?)>", plan)
    assert reads and all("wide" not in r and "rid" not in r for r in reads)
    for how in ("inner", "left", "left_semi", "left_anti"):
        want = join_using(fact, dim, "k", how)
        got = join_using(fact, dim, "k", how, salt_buckets=8)
        assert got.columns == want.columns
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0, how


def test_hot_rows_too_many_to_broadcast_are_salted(spark, tmp_path):
    fact, dim = _files(spark, tmp_path)
    joined = join_using(fact, dim, "k", salt_buckets=8, max_broadcast_rows=0, row_id=["rid"])
    plan = plan_text(joined.groupBy().count())
    assert "Generate" in plan and "BroadcastHashJoin" not in plan
    assert "wide" not in "".join(re.findall(r"ReadSchema: struct<(.*?)>", plan))
    want = join_using(fact, dim, "k")
    assert joined.exceptAll(want).count() == 0 and want.exceptAll(joined).count() == 0


def test_right_and_full_joins_scan_the_left_side_once(spark, tmp_path):
    fact, dim = _files(spark, tmp_path)
    for how in ("right", "full"):
        joined = join_using(fact, dim, "k", how, salt_buckets=8, row_id=["rid"])
        plan = plan_text(joined)
        assert len(re.findall(r"^\(\d+\) Scan parquet", plan, re.M)) == 2, how  # fact and dim
        want = join_using(fact, dim, "k", how)
        assert joined.columns == want.columns
        assert joined.exceptAll(want).count() == 0 and want.exceptAll(joined).count() == 0, how
        assert joined.filter("name IS NOT NULL AND rid IS NULL").count() == 500, how


def test_shuffled_copies_spread_by_their_row_id(spark):
    """A third of the rows are copies that stand in one partition, dealt by the key before."""
    fact = spark.range(0, 30000, numPartitions=8).selectExpr(
        "id AS rid", "CASE WHEN id % 3 = 0 THEN 7 ELSE id % 1000 END AS k",
        "CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS v").repartition(8, "k")
    copies = fact.filter("k = 7 AND v = 0").select(salt_column(fact, 8, ["rid"]).alias("b"))
    per_bucket = [r["count"] for r in copies.groupBy("b").count().collect()]
    assert len(per_bucket) == 8 and sum(per_bucket) == 10000
    assert max(per_bucket) < 2 * 10000 / 8


def test_key_filter_cuts_the_fact_before_the_shuffle(spark, tmp_path):
    fact, dim = _files(spark, tmp_path)
    some = dim.filter("k < 520")
    for how in ("inner", "left_semi", "right"):
        want = join_using(fact, some, "k", how)
        got = join_using(fact, some, "k", how, key_filter=True)
        assert got.columns == want.columns
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0, how
    plan = plan_text(join_using(fact, some, "k", key_filter=True))
    tree = plan[:plan.index("(1)")]
    lines = tree.splitlines()
    join_at = next(i for i, line in enumerate(lines) if "BroadcastHashJoin" in line)
    assert any("Exchange" in line for line in lines[:join_at])  # the shuffle is above the filter
    cut = reduce_by_keys(fact, some, "k")
    held = fact.join(some, "k", "left_semi").count()
    assert held <= cut.count() < 0.5 * fact.count()
    assert cut.columns == fact.columns


def test_key_filter_leaves_other_keys_alone(spark):
    left = spark.createDataFrame([(1.0,), (-0.0,), (None,)], "k double")
    right = spark.createDataFrame([(0.0, "a")], "k double, n string")
    assert reduce_by_keys(left, right, "k") is left
    assert join_using(left, right, "k", key_filter=True).count() == 1
    ints = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    longs = spark.createDataFrame([(2, "b"), (None, "c")], "k long, n string")
    assert [r.k for r in join_using(ints, longs, "k", key_filter=True).collect()] == [2]
    assert reduce_by_keys(ints, longs, "k", max_bits=5) is ints


def test_pipelines_with_a_hot_brand_split_and_filtered(spark):
    from collections import Counter

    from martkit.plans import REFERENCE, pipeline_v1, pipeline_v2, pipeline_v3
    product = spark.range(0, 30000, numPartitions=8).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 7 ELSE id % 100 END AS brand_id",
        "id % 10 AS category_id", "CAST(id % 40 AS BIGINT) AS discount_rate",
        "CAST(id % 6 AS DOUBLE) AS rating_average", "id % 4 AS reviews_count")
    brand = spark.range(100).selectExpr("id AS brand_id", "concat('b', id) AS brand_name")
    category = spark.range(10).selectExpr("id AS category_id", "concat('c', id) AS category_name")
    plain = REFERENCE.with_(eager=False, category_filter="category_id < 3")
    hot = plain.with_(broadcast_dims=False, salt_buckets=8, key_filter=True, row_id=("id",))
    for build in (lambda r: pipeline_v1(product, brand, r),
                  lambda r: pipeline_v2(product, brand, category, r),
                  lambda r: pipeline_v3(product, brand, category, r)):
        want, got = build(plain), build(hot)
        for name in want:
            assert Counter(map(tuple, got[name].collect())) == Counter(
                map(tuple, want[name].collect())), name
    plan = plan_text(pipeline_v1(product, brand, hot)["product_count_brand"])
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" in plan  # the hot brand is split off
    plan = plan_text(pipeline_v3(product, brand, category, hot)["agg_products_each_category"])
    assert "bit_or" in plan and "shiftright" in plan  # facts of other categories go first
