"""JDBC helpers without a database: options, secrets, guards, partitioning rules.

No database server (embedded or not) is started in this repository, so reads
and writes against PostgreSQL/MySQL/SQLite are not exercised here.
"""

import datetime

import pytest

from conftest import plan_text
from pyspark.sql import functions as F
from martkit.operators import join_using
from martkit.sinks import bounded_writers, guard_overwrite
from martkit.sources import bounds_from, driver_class, jdbc_options, jdbc_url, read_jdbc
from martkit.spec import JdbcConf


def test_driver_classes():
    assert driver_class("postgresql") == "org.postgresql.Driver"
    assert driver_class("MySQL") == "com.mysql.cj.jdbc.Driver"
    assert driver_class("sqlite") == "org.sqlite.JDBC"
    with pytest.raises(ValueError):
        driver_class("oracle")


def test_urls():
    assert jdbc_url(JdbcConf("postgresql", "test", host="db")) == "jdbc:postgresql://db:5432/test"
    assert jdbc_url(JdbcConf("mysql", "test", host="db", port=3307)) == "jdbc:mysql://db:3307/test"
    assert jdbc_url(JdbcConf("sqlite", "/data/out.db")) == "jdbc:sqlite:/data/out.db"


def test_password_comes_from_environment(monkeypatch):
    conf = JdbcConf("postgresql", "test", user="u", password_env="MARTKIT_TEST_PW")
    with pytest.raises(KeyError):
        jdbc_options(conf, "t")
    monkeypatch.setenv("MARTKIT_TEST_PW", "s3cret")
    opts = jdbc_options(conf, "t")
    assert opts["password"] == "s3cret" and opts["user"] == "u" and opts["dbtable"] == "t"


def test_overwrite_of_an_input_is_refused():
    pg = JdbcConf("postgresql", "test", host="db")
    other = JdbcConf("postgresql", "other", host="db")
    with pytest.raises(ValueError):
        guard_overwrite(pg, "product", [(pg, "brand"), (pg, "PRODUCT")])
    guard_overwrite(pg, "product", [(other, "product"), (pg, "brand")])


def test_unpartitioned_scan_must_be_explicit(spark):
    with pytest.raises(ValueError):
        read_jdbc(spark, JdbcConf("postgresql", "test"), "product")
    with pytest.raises(ValueError):
        read_jdbc(spark, JdbcConf("postgresql", "test"), "product", partition_column="brand_id")


def test_bounds_from_min_max(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/part.parquet")
    lo, hi = bounds_from(df, "p_partkey")
    assert lo == 0 and hi == df.count() - 1


def test_bounds_are_computed_by_the_database():
    from martkit.sources.jdbc import bounds_query
    assert bounds_query("product", "brand_id") == (
        "(SELECT MIN(brand_id) AS lo, MAX(brand_id) AS hi FROM product) martkit_bounds")


def test_writers_are_bounded_without_narrowing_the_plan(spark):
    # A shuffle-free plan (scan + broadcast join): Spark's own coalesce would
    # run the scan in 3 tasks; the repartition keeps the scan at full width.
    fact = spark.range(0, 4000, numPartitions=16).selectExpr("id % 50 AS k", "id AS v")
    dim = spark.range(0, 50).selectExpr("id AS k", "concat('n', id) AS name")
    out = bounded_writers(join_using(fact, dim, "k", broadcast="right"), 3)
    plan = plan_text(out)
    assert "RoundRobinPartitioning(3)" in plan and "Coalesce" not in plan
    assert out.rdd.getNumPartitions() == 3
    assert sorted(map(tuple, out.collect())) == sorted(
        map(tuple, join_using(fact, dim, "k").collect()))
    with pytest.raises(ValueError):
        bounded_writers(fact, 0)


def test_guard_sees_schema_host_case_and_sqlite():
    from martkit.sinks.jdbc import guard_overwrite
    here = JdbcConf(rdbms="postgresql", database="d", host="db", user="u")
    loud = JdbcConf(rdbms="postgresql", database="d", host="DB", user="u")
    for conf, table in ((here, "public.product"), (loud, "product"), (loud, '"PUBLIC"."product"')):
        with pytest.raises(ValueError, match="also an input"):
            guard_overwrite(here, "product", [(conf, table)])
    guard_overwrite(here, "a.product", [(here, "b.product")])
    lite = JdbcConf(rdbms="sqlite", database="/x.db")
    with pytest.raises(ValueError, match="also an input"):
        guard_overwrite(lite, "t", [(lite, "t")])


def test_quantiles_are_computed_by_the_database():
    from martkit.sources import quantile_query
    assert quantile_query("product", "brand_id", 4) == (
        "(SELECT MIN(k) AS low FROM (SELECT brand_id AS k, NTILE(4) OVER (ORDER BY brand_id) "
        "AS part FROM product WHERE brand_id IS NOT NULL) t GROUP BY part) martkit_quantiles")


@pytest.mark.parametrize("lows,want", [
    ([5, 1, 9], ["k < 5 OR k IS NULL", "k >= 5 AND k < 9", "k >= 9"]),
    (["a", "o'b", "z"], ["k < 'o''b' OR k IS NULL", "k >= 'o''b' AND k < 'z'", "k >= 'z'"]),
    ([datetime.date(2020, 1, 2), datetime.date(2021, 1, 2)],
     ["k < DATE '2021-01-02' OR k IS NULL", "k >= DATE '2021-01-02'"]),
    ([datetime.datetime(2020, 1, 2, 3), datetime.datetime(2021, 1, 2, 3, 4, 5)],
     ["k < TIMESTAMP '2021-01-02 03:04:05' OR k IS NULL", "k >= TIMESTAMP '2021-01-02 03:04:05'"]),
    ([7, 7, 7], ["1 = 1"]), ([], ["1 = 1"]),
    ([1, 4, 4, 4, 8], ["k < 4 OR k IS NULL", "k >= 4 AND k < 8", "k >= 8"]),
])
def test_range_predicates(lows, want):
    from martkit.sources import range_predicates
    assert range_predicates("k", lows, "postgresql") == want


def test_backslashes_are_escaped_where_they_escape():
    from martkit.sources.jdbc import sql_literal
    assert sql_literal("a\\'b", "mysql") == "'a\\\\''b'"
    assert sql_literal("a\\'b", "postgresql") == "'a\\''b'"


@pytest.mark.parametrize("column,lows", [("k", [0, 100, 200, 300, 300]), ("s", ["", "k1", "k3", "k7"])])
def test_ranges_cover_every_row_once(spark, column, lows):
    """The predicates are plain SQL: Spark itself counts what a database would send."""
    from martkit.sources import range_predicates
    df = spark.range(-5, 1000).selectExpr(
        "CASE WHEN id % 7 = 0 THEN NULL WHEN id % 3 = 0 THEN 300 ELSE id END AS k",
        "CASE WHEN id % 11 = 0 THEN NULL ELSE concat('k', id % 10) END AS s")
    parts = range_predicates(column, lows, "postgresql")
    hit = [F.coalesce(F.expr(p), F.lit(False)).cast("int") for p in parts]
    assert df.select(sum(hit[1:], hit[0]).alias("n")).distinct().collect() == [(1,)]


def test_each_table_has_its_own_ranges(monkeypatch):
    """Three tables of one job; no database: the reader's arguments are looked at."""
    import martkit.cli as cli
    seen = {}
    monkeypatch.setattr(cli, "read_jdbc", lambda spark, conf, table, **kw: seen.update({table: kw}))
    args = cli.build_parser().parse_args([
        "multi-join", "--store", "jdbc", "--database", "d", "--num-partitions", "6",
        "--partition", "product=id:32", "--partition", "brand=brand_name",
        "--partition-column", "category_id", "--write-partitions", "3",
        "--table", "product", "", "--output", "o"])
    store = cli._store("jdbc", args)
    for table in ("product", "brand", "category"):
        store.read(type("S", (), {"sparkContext": type("C", (), {"defaultParallelism": 4})}), table)
    assert {t: (k["partitioning"].column, k["partitioning"].parts) for t, k in seen.items()} == {
        "product": ("id", 32), "brand": ("brand_name", 6), "category": ("category_id", 6)}
    assert store.write_partitions == 3
    with pytest.raises(ValueError):
        cli.Partitioning.parse(":3", 1)
    with pytest.raises(ValueError):
        cli.Partitioning.parse("id:0", 1)
