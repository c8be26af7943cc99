"""FIXTURES.md §2: the nine edge-case rows through star split, joins and V1–V3."""

from conftest import rows

from martkit.operators import join_program, join_using
from martkit.operators.joins import Table
from martkit.plans import REFERENCE, pipeline_v1, pipeline_v2, pipeline_v3, warehouse


def test_star_split(flat):
    star = warehouse(flat)
    assert star["product"].count() == 9
    assert "brand_name" not in star["product"].columns
    assert rows(star["brand"], "brand_id", "brand_name") == [
        (None, None), (10, "X"), (20, "Y"), (30, "Z"), (30, "Z-new")]
    assert rows(star["category"], "category_id", "category_name") == [
        (None, None), (1, "Phones"), (2, "Root"), (3, "Tablets")]


def test_product_brand_join_keeps_duplicates_and_fanout(flat):
    star = warehouse(flat)
    j = join_using(star["product"], star["brand"], "brand_id",
                   left_filter=REFERENCE.product_filter)
    assert j.columns[0] == "brand_id"
    assert rows(j, "id", "brand_name") == [
        (1, "X"), (2, "X"), (4, "Y"), (4, "Y"), (5, "Z"), (5, "Z-new"),
        (6, "Z"), (6, "Z-new"), (8, "X")]


def test_three_way_drops_null_and_excluded_category(flat):
    star = warehouse(flat)
    j = join_program(
        [Table(star["product"], REFERENCE.product_filter), Table(star["brand"]),
         Table(star["category"], REFERENCE.category_filter)],
        ["0 1 brand_id inner", "3 2 category_id inner"],
    )
    assert j.columns[:2] == ["category_id", "brand_id"]
    assert rows(j, "id", "brand_name") == [
        (1, "X"), (2, "X"), (4, "Y"), (4, "Y"), (5, "Z"), (5, "Z-new"), (6, "Z"), (6, "Z-new")]


def test_v1_counts_and_sums(flat):
    star = warehouse(flat)
    roles = REFERENCE.with_(count_having="count(id) > 1")
    out = pipeline_v1(star["product"], star["brand"], roles)
    assert rows(out["product_count_brand"], "brand_id", "brand_name", "number_of_products") == [
        (10, "X", 3), (20, "Y", 2), (30, "Z", 2), (30, "Z-new", 2)]
    assert rows(out["product_sum_brand"], "brand_id", "brand_name", "number_of_reviews") == [
        (10, "X", 14), (20, "Y", 6), (30, "Z", 7), (30, "Z-new", 7)]
    # the reference's own "> 5" keeps nothing here
    assert pipeline_v1(star["product"], star["brand"])["product_count_brand"].count() == 0


def test_v1_shared_plan_gives_same_rows(flat):
    star = warehouse(flat)
    roles = REFERENCE.with_(count_having="count(id) > 1")
    out = pipeline_v1(star["product"], star["brand"], roles)
    independent = {k: sorted(map(tuple, out[k].collect())) for k in out}
    with out:
        shared = {k: sorted(map(tuple, out[k].collect())) for k in out}
    assert shared == independent


def test_v2_outputs(flat):
    star = warehouse(flat)
    out = pipeline_v2(star["product"], star["brand"], star["category"])
    assert rows(out["agg_brand_average_rate"], "brand_id", "category_id", "brand_name",
                "average_rating") == [
        (10, None, "X", 4.9), (10, 1, "X", 4.65), (30, 3, "Z", 3.5), (30, 3, "Z-new", 3.5)]
    assert rows(out["agg_products_each_category"], "category_id", "category_name",
                "number_of_products") == [(1, "Phones", 2), (3, "Tablets", 4)]
    assert rows(out["category_brand_average"], "category_id", "brand_id", "brand_name",
                "average_rating", "category_name") == [(1, 10, "X", 4.65, "Phones")]


def test_v3_outputs(flat):
    star = warehouse(flat)
    out = pipeline_v3(star["product"], star["brand"], star["category"])
    expect_avg = [(10, 1, "X", 4.65), (30, 3, "Z", 3.5), (30, 3, "Z-new", 3.5)]
    expect_cnt = [(1, "Phones", 2), (3, "Tablets", 6)]
    assert rows(out["agg_brand_average_rate"], "brand_id", "category_id", "brand_name",
                "average_rating") == expect_avg
    assert rows(out["agg_products_each_category"], "category_id", "category_name",
                "number_of_products") == expect_cnt
    with out:
        assert rows(out["agg_brand_average_rate"], "brand_id", "category_id", "brand_name",
                    "average_rating") == expect_avg
        assert rows(out["agg_products_each_category"], "category_id", "category_name",
                    "number_of_products") == expect_cnt


def test_optional_dedupe_and_unique_dims(flat):
    import pytest
    star = warehouse(flat, dedupe=True)
    assert star["product"].count() == 8
    with pytest.raises(ValueError, match="brand_id"):
        warehouse(flat, unique_dims=True)


def _all_rows(outputs):
    return {k: sorted(map(tuple, outputs[k].collect()), key=str) for k in outputs}


def test_eager_equals_join_first(flat):
    star = warehouse(flat)
    p, b, c = star["product"], star["brand"], star["category"]
    eager = REFERENCE.with_(count_having="number_of_products > 1")
    join_first = eager.with_(eager=False)
    assert _all_rows(pipeline_v1(p, b, eager)) == _all_rows(pipeline_v1(p, b, join_first))
    assert _all_rows(pipeline_v2(p, b, c, eager)) == _all_rows(pipeline_v2(p, b, c, join_first))
    assert _all_rows(pipeline_v3(p, b, c, eager)) == _all_rows(pipeline_v3(p, b, c, join_first))
    # the alias-form having keeps the V1 expectations
    out = pipeline_v1(p, b, eager)
    assert rows(out["product_count_brand"], "brand_id", "brand_name", "number_of_products") == [
        (10, "X", 3), (20, "Y", 2), (30, "Z", 2), (30, "Z-new", 2)]
    with out:
        assert rows(out["product_sum_brand"], "brand_id", "number_of_reviews") == [
            (10, 14), (20, 6), (30, 7), (30, 7)]


def test_eager_plan_aggregates_before_joining(flat):
    from conftest import plan_text
    star = warehouse(flat)
    plan = plan_text(pipeline_v3(star["product"], star["brand"], star["category"])[
        "agg_brand_average_rate"])
    first_agg = plan.index("HashAggregate")
    last_join = plan.rindex("BroadcastHashJoin")
    # the formatted tree lists the root first, so the partial aggregate of the
    # fact appears below (after) the joins in the text
    assert plan.count("HashAggregate") >= 4 and last_join > first_agg


def test_checkpointed_outputs(flat):
    from conftest import plan_text
    star = warehouse(flat)
    out = pipeline_v3(star["product"], star["brand"], star["category"]).checkpointed()
    with out:
        got = rows(out["agg_products_each_category"], "category_id", "category_name",
                   "number_of_products")
        # the outputs read the checkpointed partials, not the fact
        plan = plan_text(out["agg_products_each_category"])
        assert "Scan ExistingRDD" in plan and "checkpoint" in plan
    assert got == [(1, "Phones", 2), (3, "Tablets", 6)]


def test_checkpointed_shared_aggregates(flat):
    # The join-first shape (SharedAggregates) checkpoints like the eager one.
    from conftest import plan_text
    star = warehouse(flat)
    roles = REFERENCE.with_(eager=False)
    plain = pipeline_v3(star["product"], star["brand"], star["category"], roles)
    want = {n: rows(plain[n], *plain[n].columns) for n in plain}
    out = pipeline_v3(star["product"], star["brand"], star["category"], roles).checkpointed()
    with out:
        got = {n: rows(out[n], *out[n].columns) for n in out}
        plan = plan_text(out["agg_products_each_category"])
        assert "Scan ExistingRDD" in plan and "checkpoint" in plan
    assert got == want
    assert got["agg_products_each_category"] == [(1, "Phones", 2), (3, "Tablets", 6)]


def test_filter_on_a_brand_column_falls_back_to_join_first(flat):
    from martkit.plans import REFERENCE, pipeline_v3, warehouse
    star = warehouse(flat)
    out = {}
    for eager in (True, False):
        roles = REFERENCE.with_(rating_filter="brand_name <> 'Z'", eager=eager)
        got = pipeline_v3(star["product"], star["brand"], star["category"], roles)
        out[eager] = sorted(map(str, got["agg_brand_average_rate"].collect()))
    assert out[True] == out[False] and out[True]


def test_large_integral_ratings_average(spark, flat):
    from martkit.plans import REFERENCE, pipeline_v3, warehouse
    star = warehouse(flat.withColumn("rating_average", (flat["id"] * 0 + 2**62).cast("long")))
    out = []
    for eager in (True, False):
        got = pipeline_v3(star["product"], star["brand"], star["category"],
                          REFERENCE.with_(eager=eager))
        out.append(sorted(map(str, got["agg_brand_average_rate"].collect())))
    assert out[0] == out[1] and out[0]


def test_dedupe_keeps_null_ids_and_one_row_everywhere(spark):
    from martkit.operators.shape import drop_duplicate_facts
    df = spark.createDataFrame([(1, "b"), (1, "a"), (None, "x"), (None, "x")], "id long, v string")
    got = sorted((r.id or 0, r.v) for r in drop_duplicate_facts(df, "id").collect())
    assert got == [(0, "x"), (0, "x"), (1, "a")]
