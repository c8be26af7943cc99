import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from martkit.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app_name="martkit-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(scope="module", autouse=True)
def no_sink_view(spark):
    """The memory sink's temporary view is listed in every database: none is left to other modules."""
    yield
    spark.catalog.dropTempView("landed_rows")


FLAT_SCHEMA = (
    "id BIGINT, sku STRING, name STRING, short_description STRING, price BIGINT, "
    "original_price BIGINT, discount BIGINT, discount_rate BIGINT, rating_average DOUBLE, "
    "reviews_count BIGINT, inventory_status STRING, brand_id BIGINT, brand_name STRING, "
    "category_id BIGINT, category_name STRING"
)

# FIXTURES.md §2: (id, discount_rate, rating_average, reviews_count,
#                  brand_id, brand_name, category_id, category_name)
EDGE_ROWS = [
    (1, 12, 4.5, 10, 10, "X", 1, "Phones"),
    (2, 11, 4.8, 0, 10, "X", 1, "Phones"),
    (3, 0, 5.0, 7, 20, "Y", 2, "Root"),
    (4, 30, 0.0, 3, 20, "Y", 3, "Tablets"),
    (4, 30, 0.0, 3, 20, "Y", 3, "Tablets"),
    (5, 20, 4.0, 5, 30, "Z", 3, "Tablets"),
    (6, 30, 3.0, 2, 30, "Z-new", 3, "Tablets"),
    (7, None, 4.9, 1, None, None, 1, "Phones"),
    (8, 50, 4.9, 4, 10, "X", None, None),
]


@pytest.fixture(scope="session")
def flat(spark):
    rows = [
        (i, None, None, None, None, None, None, dr, ra, rc, None, bid, bname, cid, cname)
        for i, dr, ra, rc, bid, bname, cid, cname in EDGE_ROWS
    ]
    return spark.createDataFrame(rows, FLAT_SCHEMA)


def rows(df, *cols):
    """Sorted tuples of the given columns (None sorts first)."""
    data = [tuple(r[c] for c in cols) for r in df.collect()]
    return sorted(data, key=lambda t: tuple((v is not None, v) for v in t))


def plan_text(df) -> str:
    """The formatted physical plan as text (what ``df.explain("formatted")`` prints)."""
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()
