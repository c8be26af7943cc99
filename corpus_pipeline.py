"""Corpus pipeline: five stages from raw documents to token ids.

    python -c "import corpus_pipeline as c; c.run(spark, sf_dir)"

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
it as Parquet into the warehouse and rereads it as the next stage's documents.
All stages but the last return the columns of ``documents``.

Odd rows: null and empty texts, and texts without letters, have no language and
go in the first stage; a stage called on its own keeps them (they link with
nothing, match no benchmark item, hold no personal data and have no tokens). A
null doc_id is a value like any other. Of repeated rows of one text the second
stage keeps one; the other stages treat each row on its own. Very long texts are
handled whole. Empty tables give empty tables. Extra columns are carried along
and may have the names of the operators' outputs.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martkit.llm import bpe, decontaminate, jaccard, language, pii
from martkit.llm.common import table, workers_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
BATCH_BYTES = 2 << 20  # of the texts that go to a Python worker at once


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of the session by bytes: texts may be long, and every stage moves them.

    All stages use one set of Python workers, so their environment is set first too.
    """
    workers_path(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; narrow margins and letterless texts go."""
    small_batches(spark)
    known = language.learn(docs.filter(~language.held_out()))
    return language.identify(docs, known).filter(~F.col("rejected")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of similar texts."""
    small_batches(spark)
    return jaccard.keep_one(docs)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item, re-parameterised ones included."""
    small_batches(spark)
    found = decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark"))
    return found.filter(F.size("leaks") == 0).select(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data and the terms that disclose it replaced."""
    small_batches(spark)
    return pii.sanitise(docs).withColumn("n_chars", F.length("text").cast("long")).select(
        *docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document (little-endian unsigned 32-bit integers), their count, digests.

    The ids are decoded again; ``decoded_sha256`` is the digest of the bytes they give back.
    """
    small_batches(spark)
    return bpe.round_trip(docs, keep=["doc_id"], with_ids=True).select(
        "doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256")


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("benchmark_free", benchmark_free),
    ("personal_data", personal_data),
    ("byte_bpe", tokens),
]

#: No stage but the last can be stated in SQL; the pipeline is tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as a Parquet table and read again.

    The tables are managed ones in the shared warehouse; each is dropped, files
    included, once the next is written. The last one stays, since the returned
    frame reads it: its name is ``martkit_pipeline_<id>_<stage>``.
    """
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    run_id, before = uuid.uuid4().hex[:12], None
    for name, stage in STAGES[:-1]:
        written = f"martkit_pipeline_{run_id}_{name}"
        stage(spark, docs, sf_dir).write.format("parquet").saveAsTable(written)
        docs = spark.table(written)
        if before:
            spark.sql(f"DROP TABLE {before}")
        before = written
    return STAGES[-1][1](spark, docs, sf_dir)
