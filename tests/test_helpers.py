"""Small SURVEY keys: cache_view, tune_shuffle, time_run, sink_preview, sink_collect,
src_parquet / sink_parquet_gzip, src_csv_ids / sink_csv, checkpoint location."""

import pyarrow.parquet as pq

from martkit.operators import cached, reliable_checkpoint, set_shuffle_partitions
from martkit.session import checkpoint_dir, ensure_checkpoint_dir, scratch_path
from martkit.sinks import preview, timed, write_csv, write_parquet
from martkit.sources import read_ids, read_parquet


def test_cached_view_is_released(spark):
    df = spark.range(100).selectExpr("id % 4 AS g", "id")
    with cached(df, view="shared_input") as d:
        assert d.storageLevel.useMemory and d.storageLevel.useDisk
        a = spark.sql("SELECT g, count(id) AS n FROM shared_input GROUP BY g HAVING count(id) > 5")
        b = spark.sql("SELECT g, sum(id) AS s FROM shared_input GROUP BY g HAVING sum(id) <> 0")
        assert a.count() == 4 and b.count() == 4
    assert not spark.catalog.tableExists("shared_input")
    assert not d.storageLevel.useMemory


def test_tune_shuffle(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    set_shuffle_partitions(spark, 4)
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
    spark.conf.set("spark.sql.shuffle.partitions", old)


def test_time_run_and_console(spark, capsys):
    result, sec = timed(lambda: spark.range(10).count())
    assert result == 10 and sec >= 0
    preview(spark.range(50), n=3)
    assert "only showing top 3 rows" in capsys.readouterr().out


def test_checkpoint_dir_and_reliable_checkpoint(spark):
    base = ensure_checkpoint_dir(spark)
    assert base and checkpoint_dir(spark) == base
    assert scratch_path(spark, "x").startswith(base.rstrip("/") + "/martkit-scratch/x-")
    df = reliable_checkpoint(spark.range(20).selectExpr("id * 2 AS v"))
    assert df.count() == 20


def test_gzip_parquet_round_trip(spark):
    src = spark.read.parquet("/root/testdata/sf0.001/part.parquet")
    path = scratch_path(spark, "gz")
    write_parquet(src, path)
    files = [f for f in __import__("os").listdir(path.replace("file:", "")) if f.endswith(".parquet")]
    meta = pq.ParquetFile(path.replace("file:", "") + "/" + files[0]).metadata
    assert meta.row_group(0).column(0).compression == "GZIP"
    back = read_parquet(spark, path)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, src.collect()))


def test_csv_ids_round_trip(spark):
    ids = spark.range(5).selectExpr("id * 10 AS id")
    path = scratch_path(spark, "ids")
    write_csv(ids, path)
    back = read_ids(spark, path)
    assert back.dtypes == [("id", "bigint")]
    assert sorted(r.id for r in back.collect()) == [0, 10, 20, 30, 40]


def _plan(df):
    from conftest import plan_text
    return plan_text(df)


def test_read_responses_formats(spark, tmp_path):
    import json
    from martkit.sources import read_responses
    rows = [(200, '{"a": 1}'), (404, "x")]
    spark.createDataFrame(rows, "status INT, body STRING").write.parquet(str(tmp_path / "p"))
    (tmp_path / "j.json").write_text("\n".join(json.dumps({"status": s, "body": b}) for s, b in rows))
    (tmp_path / "t.txt").write_text('{"a": 1}\n{"b": 2}\n')
    for fmt, path, n in [("parquet", "p", 2), ("json", "j.json", 2), ("text", "t.txt", 2)]:
        df = read_responses(spark, str(tmp_path / path), fmt)
        assert df.dtypes == [("status", "int"), ("body", "string")]
        assert df.count() == n


def test_session_cleans_unreferenced_checkpoints(spark):
    conf = spark.sparkContext.getConf()
    assert conf.get("spark.cleaner.referenceTracking.cleanCheckpoints") == "true"
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
