"""The ingest operator is stateless column logic, so it runs on a stream unchanged."""

import json

from martkit.session import scratch_path
from martkit.sources import flatten_products


def test_flatten_on_a_file_stream(spark):
    src = scratch_path(spark, "landing").replace("file:", "")
    good = {"id": 1, "sku": "s", "name": "n", "short_description": "d", "price": 1,
            "original_price": 2, "discount": 1, "discount_rate": 50, "rating_average": 4.0,
            "review_count": 3, "inventory_status": "ok", "brand": {"id": 1, "name": "X"},
            "categories": {"id": 2, "name": "C"}}
    batch = spark.createDataFrame([(200, json.dumps(good)), (200, "{bad"), (404, "x")],
                                  "status INT, body STRING")
    batch.write.parquet(src)
    stream = spark.readStream.schema("status INT, body STRING").parquet(src)
    flat = flatten_products(stream)
    q = (flat.rows.writeStream.format("memory").queryName("landed_rows")
         .option("checkpointLocation", scratch_path(spark, "ckpt")).start())
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    rows = spark.sql("SELECT id, brand_id, category_name FROM landed_rows").collect()
    assert [tuple(r) for r in rows] == [(1, 1, "C")]
