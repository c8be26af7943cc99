"""Stage then swap: a failed write leaves the old table readable."""

import pytest

from conftest import rows
from pyspark.sql import functions as F

from martkit.cli import run
from martkit.sinks import (publish_table, recover_table, replace_table, replace_tables)
from martkit.sinks.tables import jdbc_catalog_conf, swap_statements
from martkit.spec import JdbcConf


@pytest.fixture()
def db(spark, tmp_path):
    spark.sql(f"CREATE DATABASE swap_db LOCATION '{tmp_path}/db'")
    yield "swap_db"
    spark.sql("DROP DATABASE swap_db CASCADE")


def failing(df):
    return df.withColumn("v", F.when(F.col("v") < 5, F.col("v")).otherwise(
        F.raise_error(F.lit("lost")).cast("bigint")))


def names(spark, db):
    return sorted(t.name for t in spark.catalog.listTables(db))


def test_replace_creates_and_replaces(spark, db):
    table = f"{db}.t"
    replace_table(spark.range(3).selectExpr("id AS v"), table)
    replace_table(spark.range(5).selectExpr("id AS v", "id AS w"), table)  # other columns
    assert rows(spark.table(table), "v", "w") == [(i, i) for i in range(5)]
    assert names(spark, db) == ["t"]


def test_failed_write_keeps_every_old_table(spark, db):
    old = {f"{db}.a": spark.range(2).selectExpr("id AS v"), f"{db}.b": spark.range(3).selectExpr("id AS v")}
    replace_tables(old)
    new = spark.range(9).selectExpr("id AS v")
    with pytest.raises(Exception, match="lost"):
        replace_tables({f"{db}.a": new, f"{db}.b": failing(new)})
    assert spark.table(f"{db}.a").count() == 2 and spark.table(f"{db}.b").count() == 3
    assert names(spark, db) == ["a", "b"]


def test_a_table_may_be_replaced_by_its_own_rows(spark, db):
    table = f"{db}.t"
    replace_table(spark.range(6).selectExpr("id AS v"), table)
    replace_table(spark.table(table).filter("v > 3"), table)
    assert rows(spark.table(table), "v") == [(4,), (5,)]


def test_a_swap_cut_short_is_recovered(spark, db):
    table = f"{db}.t"
    replace_table(spark.range(2).selectExpr("id AS v"), table)
    spark.sql(f"ALTER TABLE {table} RENAME TO {db}.t__old_1")
    spark.range(7).selectExpr("id AS v").write.saveAsTable(f"{db}.t__staged_1")
    assert recover_table(spark, table) == "t__staged_1"
    assert spark.table(table).count() == 7
    assert recover_table(spark, table) is None


def test_publish_moves_the_location(spark, db, tmp_path):
    table, root = f"{db}.ext", str(tmp_path / "ext")
    first = publish_table(spark.range(3).selectExpr("id AS v"), table, root)
    with pytest.raises(Exception, match="lost"):
        publish_table(failing(spark.range(9).selectExpr("id AS v")), table, root)
    assert spark.table(table).count() == 3
    second = publish_table(spark.range(4).selectExpr("id AS v"), table, root)
    assert spark.table(table).count() == 4 and first != second
    assert spark.read.parquet(first).count() == 3  # readers of the old folder go on
    publish_table(spark.range(1).selectExpr("id AS v", "'x' AS w"), table, root)
    assert rows(spark.table(table), "v", "w") == [(0, "x")]


def test_cli_catalog_store(spark, db, flat):
    flat.write.saveAsTable(f"{db}.product_data")
    run(["dwh", "--store", f"catalog:{db}", "--input", "product_data"])
    run(["run", "--store", f"catalog:{db}", "--version", "v2", "--checkpoint"])
    assert rows(spark.table(f"{db}.brand"), "brand_id", "brand_name") == [
        (None, None), (10, "X"), (20, "Y"), (30, "Z"), (30, "Z-new")]
    assert spark.table(f"{db}.category_brand_average").count() >= 1


def test_database_swap_statements():
    cat = "c.shop.product"
    assert swap_statements(cat, f"{cat}__staged_1", True, f"{cat}__old_1") == [
        "ALTER TABLE c.shop.product RENAME TO product__old_1",
        "ALTER TABLE c.shop.product__staged_1 RENAME TO product",
        "DROP TABLE c.shop.product__old_1"]
    assert swap_statements("t", "t__staged_1", False, "t__old_1") == [
        "ALTER TABLE t__staged_1 RENAME TO t"]


def test_database_catalog_settings(monkeypatch):
    monkeypatch.setenv("DB_PASS", "x")
    conf = JdbcConf("postgresql", "shop", host="db", user="u", password_env="DB_PASS")
    assert jdbc_catalog_conf(conf, "c") == {
        "spark.sql.catalog.c":
            "org.apache.spark.sql.execution.datasources.v2.jdbc.JDBCTableCatalog",
        "spark.sql.catalog.c.url": "jdbc:postgresql://db:5432/shop",
        "spark.sql.catalog.c.driver": "org.postgresql.Driver",
        "spark.sql.catalog.c.user": "u", "spark.sql.catalog.c.password": "x"}
