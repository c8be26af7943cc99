"""Several outputs of one input: tagged one-pass aggregates, held intermediates, one parse."""

import re

import pytest

from conftest import plan_text, rows
from pyspark.sql import functions as F

from martkit.operators import aggregate_many, star_split
from martkit.operators.aggregate import _TAG
from martkit.plans import REFERENCE, pipeline_v2, pipeline_v3, warehouse
from martkit.sources import flatten_products
from martkit.spec import AggSpec, Measure


def scans(df) -> int:
    """File scans that the plan runs (reused exchanges are listed once)."""
    return len(re.findall(r"^\(\d+\) Scan parquet", plan_text(df), re.M))


def bag(df):
    return sorted(map(tuple, df.collect()), key=lambda t: tuple((v is not None, v) for v in t))


@pytest.mark.parametrize("text,want", [
    ("count(id) AS n", Measure("count", "id")),
    ("count(*)", Measure("count", "1")),
    ("round(avg(a * (b + 1)), 2) as x", Measure("avg", "a * (b + 1)", 2)),
    ("sum(DISTINCT x) AS `s t`", Measure("sum", "x", None, True)),
    ("Round( Max(concat(a, ',')) , 0 )", Measure("max", "concat(a, ',')", 0)),
    ("percentile(x, 0.5) AS p", None),
    ("sum(x) / count(x) AS r", None),
    ("round(sum(x) / 2, 1) AS r", None),
    ("collect_list(x)", None),
])
def test_measures_are_read_from_text(text, want):
    assert Measure.parse(text) == want


@pytest.fixture(scope="module")
def data(spark):
    rows = [("a", 1, 10.0), ("a", 2, None), ("b", 0, 5.0), ("b", None, None), (None, 5, 1.0)]
    return spark.createDataFrame(rows, "g STRING, id BIGINT, v DOUBLE")


SPECS = [
    AggSpec.of(["g"], ["sum(10 div id) AS s", "count(*) AS n"], where="id <> 0", name="guarded"),
    AggSpec.of(["id"], ["max(v) AS mx", "count(DISTINCT g) AS d"], name="by_id"),
    AggSpec.of(["upper(g)"], ["count(1) AS n"], where="id >= 0", having="count(1) >= 2", name="up"),
    AggSpec.of(["g", "id"], ["round(avg(v / 3), 2) AS r"], having="r > 1", name="two_keys"),
    AggSpec.of([], ["count(id) AS n", "sum(v) AS s"], where="v > 100", name="whole"),
    AggSpec.of([], ["count(id) AS n"], having="count(id) > 0", name="whole_if_any"),
]


@pytest.mark.parametrize("empty", [False, True])
@pytest.mark.parametrize("reliable", [False, True])
def test_specs_that_differ_share_one_tagged_pass(data, empty, reliable):
    frame = data.limit(0) if empty else data
    out = aggregate_many(frame, SPECS)
    want = {k: (out[k].columns, bag(out[k])) for k in out}
    assert {k: (f.columns, bag(f)) for k, f in out.onepass.items()} == want
    with out.checkpointed() if reliable else out:
        assert {k: (out[k].columns, bag(out[k])) for k in out} == want
    if not empty:
        assert want["guarded"][1] == [(None, 2, 1), ("a", 15, 2)]  # no division by the zero
        assert want["whole"][1] == [(0, None)]


def test_held_frame_has_one_row_per_group_and_spec(data):
    out = aggregate_many(data, SPECS)
    assert _TAG in out.combined.columns and "v" not in out.combined.columns
    assert out.combined.count() == 2 + 5 + 3 + 5 + 0 + 1


def test_other_aggregates_still_give_their_results(data):
    specs = [AggSpec.of(["g"], ["collect_set(id) AS ids"], name="a"),
             AggSpec.of(["id"], [F.sum("v").alias("s")], name="b")]
    out = aggregate_many(data, specs)
    want = bag(out["b"])
    with out:
        assert bag(out["b"]) == want
        assert {r.g: sorted(r.ids) for r in out["a"].collect()} == {
            None: [5], "a": [1, 2], "b": [0]}


def _star(spark, tmp_path, n=3000):
    spark.range(n).selectExpr(
        "id", "id % 50 AS brand_id", "id % 10 AS category_id", "id % 40 AS discount_rate",
        "CAST(id % 6 AS DOUBLE) AS rating_average", "id % 4 AS reviews_count").write.parquet(
        str(tmp_path / "product"))
    product = spark.read.parquet(str(tmp_path / "product"))
    brand = spark.range(50).selectExpr("id AS brand_id", "concat('b', id % 45) AS brand_name")
    category = spark.range(10).selectExpr("id AS category_id", "concat('c', id) AS category_name")
    return product, brand, category


def test_v3_join_first_holds_group_rows_of_one_scan(spark, tmp_path):
    roles = REFERENCE.with_(eager=False, category_filter="category_id <> 2")
    product, brand, category = _star(spark, tmp_path)
    out = pipeline_v3(product, brand, category, roles)
    assert scans(out.combined) == 1
    want = {k: bag(out[k]) for k in out}
    assert out.combined.count() == len(want["agg_brand_average_rate"]) + len(
        want["agg_products_each_category"])
    with out.checkpointed():
        assert {k: bag(out[k]) for k in out} == want


@pytest.mark.parametrize("eager", [True, False])
def test_v2_average_is_one_intermediate_and_checkpoints(spark, tmp_path, eager):
    product, brand, category = _star(spark, tmp_path)
    out = pipeline_v2(product, brand, category,
                      REFERENCE.with_(eager=eager, average_filter="average_rating > 2"))
    want = {k: bag(out[k]) for k in out}
    assert list(out) == ["product_brand_tmp", "product_category_tmp", "agg_brand_average_rate",
                         "agg_products_each_category", "category_brand_average"]
    with out.checkpointed():
        assert {k: bag(out[k]) for k in out} == want
        for name in ("agg_brand_average_rate", "category_brand_average"):
            plan = plan_text(out[name])  # the average is read from its checkpoint
            assert "Scan ExistingRDD" in plan and "Scan parquet" not in plan
        plan = plan_text(out["agg_products_each_category"])
        assert ("Scan parquet" in plan) == (not eager)
    assert want["product_brand_tmp"] and want["category_brand_average"]


def test_star_split_of_a_join_runs_it_once(spark, tmp_path):
    product, brand, category = _star(spark, tmp_path)
    flat = product.join(brand, "brand_id").join(category, "category_id")
    star = star_split(flat, product.columns, {"brand": ["brand_id", "brand_name"],
                                              "category": ["category_id", "category_name"]})
    want = {k: bag(star[k]) for k in star}
    with star:
        assert {k: bag(star[k]) for k in star} == want
        assert all("InMemoryTableScan" in plan_text(star[k]) for k in star)
    with star.checkpointed():
        assert {k: bag(star[k]) for k in star} == want
        assert not any("Scan parquet" in plan_text(star[k]) for k in star)
    assert set(warehouse(flat)) == {"product", "brand", "category"}


def test_documents_are_parsed_once_for_both_sinks(spark):
    good = ('{"id":1,"sku":null,"name":"n","short_description":"s","price":1,"original_price":1,'
            '"discount":0,"discount_rate":0,"rating_average":1.5,"review_count":2,'
            '"inventory_status":"a","brand":{"id":1,"name":"b"},"categories":{"id":2,"name":"c"}}')
    calls = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(body):
        calls.add(1)
        return body

    docs = spark.createDataFrame([(200, good), (200, "{bad"), (404, good)], "status int, body string")
    docs = docs.filter("status = 200").withColumn("body", counted("body"))
    for hold in (lambda f: f, lambda f: f.checkpointed()):
        before = calls.value
        with hold(flatten_products(docs)) as out:
            assert out.rows.count() == 1
            assert rows(out.rejected, "reason") == [("unparseable or duplicate keys",)]
        assert calls.value - before == 2  # each document once
