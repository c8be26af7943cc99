"""The corpus pipeline on sf0.001, each stage against what it must keep and change."""

import array
import hashlib

import pytest

import corpus_pipeline
from martkit.llm import bpe, pii

from .conftest import frame
from .test_corpus import brute_components

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("pipe") / name)
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append((name, docs))
    return out


def test_stages(stages):
    kept = [{r.doc_id: r.asDict() for r in df.collect()} for _, df in stages]
    columns = stages[0][1].columns
    assert all(df.columns == columns for _, df in stages[:-1])
    first, known, single, free, clean, coded = kept
    assert len(known) >= 0.97 * len(first)
    ids = sorted(known)
    comps, sizes = brute_components([known[i]["text"] for i in ids])
    want = {ids[c] for c in comps} | {i for i, n in zip(ids, sizes) if not n}
    assert set(single) == want
    bench = [r.text for r in stages[0][1].sparkSession.read.parquet(
        f"{SF}/benchmark.parquet").collect()]
    leaked = {i for i, r in single.items() if any(b in r["text"] for b in bench)}
    assert leaked and not leaked & set(free)
    assert set(free) == set(clean) == set(coded)
    library = bpe.encoding(bpe.read_ranks(), bpe.public_tokenizers.PATTERN)
    for i, r in clean.items():
        assert not pii.base_spans(r["text"])
        assert r["n_chars"] == len(r["text"])
        if not pii.base_spans(free[i]["text"]):
            assert r["text"] == free[i]["text"]
        assert bytes(coded[i]["ids"]) == array.array(
            "I", library.encode_ordinary(r["text"])).tobytes()


def test_ids_give_back_the_text(stages):
    clean = {r.doc_id: r.text for r in stages[-2][1].collect()}
    coded = {r.doc_id: r.decoded_sha256 for r in stages[-1][1].collect()}
    assert coded == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in clean.items()}


ODD = [(1, None), (2, ""), (3, " \n"), (4, "123 !"), (None, "the cat sat on the mat with the dog"),
       (5, "the cat sat on the mat with the dog"), (5, "the cat sat on the mat with the dog"),
       (6, "der hund und die katze sitzen im haus"), (7, "x" * 200_000), (8, "the " * 20_000),
       (9, "write to bob@corp.com about the house"), (10, "write to bob@corp.com about the house")]


@pytest.mark.parametrize("empty", [False, True])
@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_on_odd_rows(spark, name, stage, empty):
    rows = [(i, t, ["en", "de", None][n % 3], "s", len(t or ""), "clash", 3)
            for n, (i, t) in enumerate(ODD)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, "
                                       "n_chars long, key string, Leaks int")
    out = stage(spark, docs.limit(0) if empty else docs, SF)
    got = out.collect()
    if name != "byte_bpe":
        assert out.columns == docs.columns
    if empty:
        assert got == []
        return
    ids = sorted((r.doc_id or 0 for r in got))
    if name == "language_id":
        assert not {1, 2, 3, 4} & set(ids) and {6, 8} <= set(ids)
    elif name == "near_duplicates":  # one of the equal texts, every text without words
        assert {1, 2, 3, 4, 6, 7, 8} <= set(ids) and len([i for i in ids if i in (0, 5)]) == 1
        assert len([i for i in ids if i in (9, 10)]) == 1
    else:
        assert ids == sorted(i or 0 for i, _ in ODD)
    if name == "personal_data":
        texts = {r.doc_id: r.text for r in got}
        assert "bob@corp.com" not in texts[9] and texts[1] is None and texts[2] == ""
    if name == "byte_bpe":
        by_id = {r.doc_id: r for r in got}
        assert by_id[1].n_tokens == by_id[2].n_tokens == 0
        assert by_id[7].decoded_sha256 == hashlib.sha256(b"x" * 200_000).hexdigest()


def test_run_gives_the_last_stage_and_drops_its_tables(spark, stages):
    got = {r.doc_id: r.decoded_sha256 for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == {r.doc_id: r.decoded_sha256 for r in stages[-1][1].collect()}
    left = [t.name for t in spark.catalog.listTables() if t.name.startswith("martkit_pipeline_")]
    assert len(left) == 1 and left[0].endswith("personal_data")
    spark.sql(f"DROP TABLE {left[0]}")


def test_stages_bound_the_bytes_that_go_to_a_worker(spark):
    import pyarrow as pa
    docs = frame(spark, ["word " * 40_000] * 30).repartition(1)
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    try:
        corpus_pipeline.language_id(spark, docs, "")
        sizes = docs.select("text").mapInArrow(
            lambda batches: (pa.RecordBatch.from_pydict({"n": [b.nbytes]}) for b in batches),
            "n long").collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", before)
    assert max(r.n for r in sizes) <= 2 * corpus_pipeline.BATCH_BYTES


def test_one_kind_of_python_workers(spark, monkeypatch):
    """No stage makes a frame by an RDD, and all functions come with one environment."""
    from pyspark.sql import SparkSession
    from martkit.llm import common

    docs = frame(spark, ["the cat sat on the mat with a dog and a bird"] * 3 + [
        f"the cat sat on the mat with {w} and a bird" for w in ("one", "two", None)])
    docs = docs.localCheckpoint()
    env = spark.sparkContext.environment
    monkeypatch.delitem(env, "PYTHONPATH", raising=False)
    monkeypatch.setattr(SparkSession, "createDataFrame", None)
    seen = set()
    for name, stage in corpus_pipeline.STAGES:
        seen.add(stage(spark, docs, SF).count() >= 0 and env.get("PYTHONPATH"))
    assert len(seen) == 1 and None not in seen
    none = common.no_rows(spark, "node binary, n long, s array<long>")
    assert none.dtypes == [("node", "binary"), ("n", "bigint"), ("s", "array<bigint>")]
    assert none.count() == 0 and "Range" not in none._jdf.queryExecution().optimizedPlan().toString()


def test_a_worker_gives_back_what_a_task_freed():
    from martkit.llm.common import in_arrow

    def held() -> int:
        with open("/proc/self/smaps_rollup") as f:
            return next(int(x.split()[1]) for x in f if x.startswith("Pss_Anon")) / 1024

    class Rows:
        def mapInArrow(self, run, schema):
            return run

    last = []

    def run(batches):
        for _ in batches:
            small = [bytes(1000) for _ in range(100_000)]
            last[:] = small[-1:]  # the piece at the heap's end stays, so malloc keeps the others
            del small
            yield held()

    before = held()
    most, = in_arrow(Rows(), run, "")([None])
    assert most > before + 60
    assert held() < before + 30
