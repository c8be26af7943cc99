"""The command-line jobs end to end on a Parquet store (the V1 and V3 shapes)."""

import pytest

from conftest import rows
from martkit.cli import run, split_list


def test_split_list():
    assert split_list("brand_id, category_id, brand_name") == ["brand_id", "category_id", "brand_name"]
    assert split_list("round(avg(x), 2) as a, count(id)") == ["round(avg(x), 2) as a", "count(id)"]
    assert split_list("concat(a, ',', b)") == ["concat(a, ',', b)"]


@pytest.fixture()
def store(spark, flat, tmp_path):
    flat.write.parquet(str(tmp_path / "product_data"))
    return f"parquet:{tmp_path}"


def test_v3_shape(spark, store, tmp_path):
    run(["dwh", "--store", store, "--input", "product_data"])
    run(["multi-join", "--store", store,
         "--table", "product", "discount_rate > 10", "--table", "brand", "",
         "--table", "category", "category_id NOT IN (2, 28856)",
         "--step", "0 1 brand_id inner", "--step", "3 2 category_id inner",
         "--output", "product_brand_category"])
    run(["agg", "--store", store, "--input", "product_brand_category",
         "--filter", "rating_average > 0",
         "--aggregations", "round(avg(rating_average), 2) as average_rating",
         "--group", "brand_id, category_id, brand_name", "--output", "agg_brand_average_rate"])
    out = spark.read.parquet(str(tmp_path / "agg_brand_average_rate"))
    assert rows(out, "brand_id", "category_id", "brand_name", "average_rating") == [
        (10, 1, "X", 4.65), (30, 3, "Z", 3.5), (30, 3, "Z-new", 3.5)]


def test_v1_shape(spark, store, tmp_path):
    run(["dwh", "--store", store, "--input", "product_data"])
    run(["join-agg", "--store", store, "--left", "brand", "--right", "product",
         "--right-filter", "discount_rate > 10", "--on", "brand_id",
         "--output", "product_count_brand", "count(id) AS number_of_products",
         "brand_id, brand_name", "count(id) > 1",
         "--output", "product_sum_brand", "sum(reviews_count) AS number_of_reviews",
         "brand_id, brand_name", "sum(reviews_count) <> 0"])
    cnt = spark.read.parquet(str(tmp_path / "product_count_brand"))
    total = spark.read.parquet(str(tmp_path / "product_sum_brand"))
    assert rows(cnt, "brand_id", "brand_name", "number_of_products") == [
        (10, "X", 3), (20, "Y", 2), (30, "Z", 2), (30, "Z-new", 2)]
    assert rows(total, "brand_id", "brand_name", "number_of_reviews") == [
        (10, "X", 14), (20, "Y", 6), (30, "Z", 7), (30, "Z-new", 7)]


def test_overwriting_an_input_is_refused(store):
    with pytest.raises(ValueError, match="also an input"):
        run(["agg", "--store", store, "--input", "product_data", "--group", "id",
             "--aggregations", "count(1) AS n", "--output", "product_data"])


@pytest.mark.parametrize("version,table,expected", [
    ("v3", "agg_products_each_category", [(1, "Phones", 2), (3, "Tablets", 6)]),
    ("v2", "agg_products_each_category", [(1, "Phones", 2), (3, "Tablets", 4)]),
])
def test_whole_pipeline(spark, store, tmp_path, version, table, expected):
    run(["run", "--store", store, "--version", version, "--input", "product_data"])
    out = spark.read.parquet(str(tmp_path / table))
    assert rows(out, "category_id", "category_name", "number_of_products") == expected


def test_whole_v1_pipeline(spark, store, tmp_path):
    run(["run", "--store", store, "--version", "v1", "--checkpoint"])
    assert spark.read.parquet(str(tmp_path / "product_count_brand")).count() == 0  # "> 5"
    assert spark.read.parquet(str(tmp_path / "product_sum_brand")).count() == 4


def test_wordcount_literal_text(capsys, tmp_path):
    run(["wordcount", "--store", f"parquet:{tmp_path}",
         "--text", "Hello World", "--text", "Hello Spark", "--text", "Hello Airflow",
         "--drop-trailing-empty"])
    lines = [line for line in capsys.readouterr().out.splitlines() if not line.startswith("{")]
    assert sorted(lines) == ["Airflow 1", "Hello 3", "Spark 1", "World 1"]


def test_ingest_text_dump(spark, tmp_path):
    import json
    good = {"id": 1, "sku": "s", "name": "n", "short_description": "d", "price": 1,
            "original_price": 2, "discount": 1, "discount_rate": 50, "rating_average": 4.0,
            "review_count": 3, "inventory_status": "ok", "brand": {"id": 1, "name": "X"},
            "categories": {"id": 2, "name": "C"}}
    dump = tmp_path / "responses.txt"
    dump.write_text(json.dumps(good) + "\n" + "{broken\n")
    run(["ingest", "--store", f"parquet:{tmp_path}", "--input", str(dump), "--format", "text"])
    assert spark.read.parquet(str(tmp_path / "product_data")).count() == 1
    rejected = spark.read.parquet(str(tmp_path / "product_data_rejected")).collect()
    assert [r.reason for r in rejected] == ["unparseable or duplicate keys"]


def test_jdbc_star_input_is_checkpointed_once(spark, flat, tmp_path, monkeypatch):
    # No database here: the JDBC store's reader is replaced by the edge rows,
    # so only the wiring is checked (checkpoint instead of persist, outputs whole).
    import martkit.cli as cli
    import martkit.operators.shared as shared
    monkeypatch.setattr(cli.Store, "read", lambda self, spark, table: flat)
    real, calls = shared.reliable_checkpoint, []

    def counting(df):
        calls.append(df)
        return real(df)
    monkeypatch.setattr(shared, "reliable_checkpoint", counting)
    run(["dwh", "--store", "jdbc", "--database", "test", "--out-store", f"parquet:{tmp_path}",
         "--input", "product_data", "--checkpoint"])
    assert len(calls) == 1
    assert spark.read.parquet(str(tmp_path / "product")).count() == flat.count()
    assert rows(spark.read.parquet(str(tmp_path / "brand")), "brand_id", "brand_name") == [
        (None, None), (10, "X"), (20, "Y"), (30, "Z"), (30, "Z-new")]


def test_join_with_salting_and_hot_keys(spark, store, tmp_path):
    run(["dwh", "--store", store, "--input", "product_data"])
    base = ["join", "--store", store, "--left", "product", "--right", "brand", "--on", "brand_id"]
    for i, (how, extra) in enumerate([("inner", ["--salt-buckets", "4"]),
                                      ("inner", ["--salt-buckets", "4", "--hot", "auto"]),
                                      ("full", ["--salt-buckets", "4", "--hot", "10, 30"]),
                                      ("inner", ["--broadcast", "right"])]):
        run([*base, "--how", how, "--output", f"want{i}"])
        run([*base, "--how", how, "--output", f"got{i}", *extra])
        want = spark.read.parquet(str(tmp_path / f"want{i}"))
        got = spark.read.parquet(str(tmp_path / f"got{i}"))
        assert rows(got, *want.columns) == rows(want, *want.columns), extra


def test_multi_join_with_salting(spark, store, tmp_path):
    run(["dwh", "--store", store, "--input", "product_data"])
    base = ["multi-join", "--store", store,
            "--table", "product", "discount_rate > 10", "--table", "brand", "",
            "--table", "category", "category_id NOT IN (2, 28856)",
            "--step", "0 1 brand_id inner", "--step", "3 2 category_id left"]
    run([*base, "--output", "want"])
    run([*base, "--output", "got", "--salt-buckets", "4", "--hot", "auto"])
    want = spark.read.parquet(str(tmp_path / "want"))
    got = spark.read.parquet(str(tmp_path / "got"))
    assert rows(got, *want.columns) == rows(want, *want.columns)
    assert got.count() > 0


def test_wordcount_of_a_table_is_whole(spark, tmp_path):
    spark.range(3000).selectExpr("concat('w', id) AS text").write.parquet(str(tmp_path / "words"))
    store = f"parquet:{tmp_path}"
    run(["wordcount", "--store", store, "--input", "words", "--output", "counts"])
    assert spark.read.parquet(str(tmp_path / "counts")).count() == 3000
    with pytest.raises(SystemExit):
        run(["wordcount", "--store", store, "--input", "words"])


def test_wordcount_prints_every_literal_word(capsys, tmp_path):
    run(["wordcount", "--store", f"parquet:{tmp_path}", "--text",
         " ".join(f"w{i}" for i in range(1500))])
    lines = [x for x in capsys.readouterr().out.splitlines() if not x.startswith("{")]
    assert len(lines) == 1500


def test_run_reads_the_store_it_wrote(spark, flat, store, tmp_path):
    # stale star tables in the input store must not be used
    for name, cols in (("product", ["id", "brand_id", "category_id", "rating_average"]),
                       ("brand", ["brand_id", "brand_name"]),
                       ("category", ["category_id", "category_name"])):
        flat.limit(1).select(*cols).write.parquet(str(tmp_path / name))
    out = tmp_path / "other"
    run(["run", "--version", "v3", "--store", store, "--out-store", f"parquet:{out}",
         "--input", "product_data"])
    got = spark.read.parquet(str(out / "agg_products_each_category"))
    assert rows(got, "category_id", "category_name", "number_of_products") == [
        (1, "Phones", 2), (3, "Tablets", 6)]


def test_overwrite_guard_compares_paths(spark, store, tmp_path):
    again = ["--group", "id", "--aggregations", "count(1) AS n", "--output", "product_data"]
    for other in (f"{store}/", f"parquet:file:{tmp_path}", f"parquet:{tmp_path}/./"):
        with pytest.raises(ValueError, match="also an input"):
            run(["agg", "--store", store, "--out-store", other, "--input", "product_data", *again])
