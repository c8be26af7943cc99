"""Property tests against brute force on small random tables.

Random keys include nulls, duplicate facts and duplicate dimension keys (the
fan-out cases); every result is compared with a plain-Python evaluation.
"""

from collections import Counter, defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from martkit.operators import aggregate, join_using
from martkit.plans import REFERENCE, pipeline_v1, pipeline_v3

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

keys = st.one_of(st.none(), st.integers(0, 4))
left_rows = st.lists(st.tuples(keys, st.integers(-3, 3)), max_size=12)
right_rows = st.lists(st.tuples(keys, st.sampled_from(["a", "b", "c"])), max_size=8)


def brute_join(left, right, how):
    out = []
    matched_right = set()
    for lk, lv in left:
        hits = [(i, rv) for i, (rk, rv) in enumerate(right) if lk is not None and lk == rk]
        if how in ("inner", "left", "full"):
            for i, rv in hits:
                out.append((lk, lv, rv))
                matched_right.add(i)
            if not hits and how in ("left", "full"):
                out.append((lk, lv, None))
        elif how == "right":
            for i, rv in hits:
                matched_right.add(i)
                out.append((lk, lv, rv))
        elif how == "left_semi" and hits:
            out.append((lk, lv))
        elif how == "left_anti" and not hits:
            out.append((lk, lv))
    if how in ("right", "full"):
        for i, (rk, rv) in enumerate(right):
            if i not in matched_right:
                out.append((rk, None, rv))
    return Counter(out)


@SETTINGS
@given(left=left_rows, right=right_rows)
def test_every_join_type_matches_brute_force(spark, left, right):
    ldf = spark.createDataFrame(left, "k INT, lv INT")
    rdf = spark.createDataFrame(right, "k INT, rv STRING")
    for how in ("inner", "left", "right", "full", "left_semi", "left_anti"):
        got = Counter(tuple(r) for r in join_using(ldf, rdf, "k", how).collect())
        assert got == brute_join(left, right, how), how


@SETTINGS
@given(left=left_rows, right=right_rows)
def test_salted_joins_match_brute_force(spark, left, right):
    ldf = spark.createDataFrame(left, "k INT, lv INT").repartition(3)
    rdf = spark.createDataFrame(right, "k INT, rv STRING")
    for how in ("inner", "left", "right", "full", "left_semi", "left_anti"):
        for hot in (None, [1, 3]):
            got = join_using(ldf, rdf, "k", how, salt_buckets=4, hot=hot).collect()
            assert Counter(tuple(r) for r in got) == brute_join(left, right, how), (how, hot)


@SETTINGS
@given(rows=st.lists(st.tuples(keys, st.one_of(st.none(), st.integers(-5, 5))), max_size=15),
       threshold=st.integers(0, 3))
def test_aggregate_with_where_and_having(spark, rows, threshold):
    df = spark.createDataFrame(rows, "g INT, v INT")
    out = aggregate(df, ["g"], ["count(v) AS n", "sum(v) AS s"], where="v IS NULL OR v > -4",
                    having=f"count(v) >= {threshold}")
    groups = defaultdict(list)
    for g, v in rows:
        if v is None or v > -4:
            groups[g].append(v)
    want = set()
    for g, vs in groups.items():
        nn = [v for v in vs if v is not None]
        if len(nn) >= threshold:
            want.add((g, len(nn), sum(nn) if nn else None))
    assert {tuple(r) for r in out.collect()} == want


facts = st.lists(st.tuples(
    st.integers(1, 6),                                 # id (duplicates allowed)
    st.one_of(st.none(), st.integers(0, 30)),          # discount_rate
    st.one_of(st.none(), st.sampled_from([0.0, 1.5, 3.25, 4.0, 5.0])),
    st.one_of(st.none(), st.integers(0, 9)),           # reviews_count
    st.one_of(st.none(), st.integers(1, 3)),           # brand_id
    st.one_of(st.none(), st.integers(1, 3)),           # category_id
), max_size=14)
dims = st.lists(st.tuples(st.one_of(st.none(), st.integers(1, 3)), st.sampled_from(["x", "y"])),
                max_size=5)


def _bag(outputs):
    return {k: Counter(tuple(r) for r in outputs[k].collect()) for k in outputs}


@SETTINGS
@given(rows=facts, brands=dims, cats=dims)
def test_eager_pipelines_equal_join_first(spark, rows, brands, cats):
    product = spark.createDataFrame(
        [(i, d, r, c, b, k) for i, d, r, c, b, k in rows],
        "id BIGINT, discount_rate BIGINT, rating_average DOUBLE, reviews_count BIGINT, "
        "brand_id BIGINT, category_id BIGINT")
    brand = spark.createDataFrame(brands, "brand_id BIGINT, brand_name STRING")
    category = spark.createDataFrame(cats, "category_id BIGINT, category_name STRING")
    roles = REFERENCE.with_(product_filter="discount_rate > 10", category_filter="category_id <> 2",
                            count_having="number_of_products > 1", broadcast_dims=False)
    join_first = roles.with_(eager=False)
    assert _bag(pipeline_v1(product, brand, roles)) == _bag(pipeline_v1(product, brand, join_first))
    assert (_bag(pipeline_v3(product, brand, category, roles))
            == _bag(pipeline_v3(product, brand, category, join_first)))
