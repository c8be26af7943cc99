"""FIXTURES.md §3: product-document accept/reject rules; listing responses."""

import json

import pytest
from pyspark.errors import PySparkException

from martkit.sources import flatten_products, listing_ids


def doc(**overrides):
    base = {
        "id": 1, "sku": "S1", "name": "n", "short_description": "d", "price": 100,
        "original_price": 120, "discount": 20, "discount_rate": 17, "rating_average": 4.5,
        "review_count": 3, "inventory_status": "available",
        "brand": {"id": 7, "name": "X"}, "categories": {"id": 9, "name": "Phones"},
        "extra": "ignored",
    }
    for k, v in overrides.items():
        if v is ...:
            base.pop(k)
        else:
            base[k] = v
    return json.dumps(base)


CASES = [
    ("ok", doc(), None),
    ("brand id null", doc(brand={"id": None, "name": "X"}), None),
    ("brand id missing", doc(brand={"name": "X"}), "missing key brand_id"),
    ("brand null", doc(brand=None), "not an object brand"),
    ("brand string", doc(brand="x"), "not an object brand"),
    ("brand list", doc(brand=[1, 2]), "not an object brand"),
    ("brand absent", doc(brand=...), "missing key brand_id"),
    ("bad json", "{bad", "unparseable or duplicate keys"),
    ("top array", "[1]", "not an object"),
    ("sku null", doc(sku=None), None),
    ("sku absent", doc(sku=...), "missing key sku"),
    ("duplicate key", '{"id": 1, "id": 2}', "unparseable or duplicate keys"),
    ("uncastable price", doc(price="12.5k"), "bad type price"),
    ("fractional price", doc(price=12.5), "bad type price"),
    ("int rating", doc(rating_average=4), None),
]


@pytest.fixture(scope="module")
def flattened(spark):
    data = [(200, body, name) for name, body, _ in CASES] + [(404, doc(id=99), "not found")]
    df = spark.createDataFrame(data, "status INT, body STRING, case STRING")
    return flatten_products(df)


def test_kept_rows(flattened):
    got = {r["id"]: r for r in flattened.rows.collect()}
    assert 99 not in got  # status 404 is skipped, not rejected
    assert flattened.rows.count() == sum(1 for _, _, why in CASES if why is None)
    row = got[1]
    assert row["reviews_count"] == 3 and row["brand_id"] in (7, None)
    assert flattened.rows.columns == [
        "id", "sku", "name", "short_description", "price", "original_price", "discount",
        "discount_rate", "rating_average", "reviews_count", "inventory_status", "brand_id",
        "brand_name", "category_id", "category_name"]
    assert dict(flattened.rows.dtypes)["rating_average"] == "double"


def test_explicit_nulls_are_kept(flattened):
    r = flattened.rows.collect()
    assert any(x["brand_id"] is None and x["brand_name"] == "X" for x in r)
    assert any(x["sku"] is None for x in r)
    assert any(x["rating_average"] == 4.0 for x in r)


def test_rejections_have_reasons(flattened):
    got = sorted((r["body"], r["reason"]) for r in flattened.rejected.collect())
    expected = sorted((body, why) for _, body, why in CASES if why is not None)
    assert got == expected


def test_listing_ids(spark):
    pages = [
        (200, json.dumps({"data": [{"id": 1}, {"id": 2}, {"x": 0}]})),
        (200, json.dumps({"data": [{"id": 2}]})),
        (500, "oops"),
    ]
    df = spark.createDataFrame(pages, "status INT, body STRING")
    ids = sorted((r["id"] for r in listing_ids(df).collect()), key=lambda v: (v is not None, v))
    assert ids == [None, 1, 2, 2]


def test_listing_without_data_fails_or_skips(spark):
    df = spark.createDataFrame([(200, '{"items": []}'), (200, '{"data": [{"id": 5}]}')],
                               "status INT, body STRING")
    with pytest.raises(PySparkException):
        listing_ids(df).collect()
    assert [r["id"] for r in listing_ids(df, on_missing="skip").collect()] == [5]
