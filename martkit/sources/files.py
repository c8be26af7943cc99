"""File sources: Parquet landing data, CSV id lists, in-memory text."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ID_SCHEMA = T.StructType([T.StructField("id", T.LongType(), True)])


def read_parquet(spark: SparkSession, path: str | list[str], tasks: int = 0) -> DataFrame:
    """Parquet (any codec; the codec is read from the file, not an option).

    Filters and projections applied later reach the scan (pushed filters,
    pruned read schema); partitioned layouts get partition pruning. ``tasks``
    deals the rows of a table of fewer files than that over so many tasks
    (``deal_out``); off by default.
    """
    paths = [path] if isinstance(path, str) else list(path)
    return deal_out(spark.read.parquet(*paths), tasks)


def deal_out(df: DataFrame, tasks: int) -> DataFrame:
    """The rows of a file source of fewer than ``tasks`` files, dealt over that many tasks.

    For costly work per row (parsing, splitting text) on a table landed as one
    file of one row group, which Spark reads in one task however large it is. The
    rows move once, so select the columns first. A table of many files is left as
    it is.
    """
    return df.repartition(tasks) if 0 < len(df.inputFiles()) < tasks else df


def read_landing(spark: SparkSession, path: str) -> DataFrame:
    """The flat product table landed as (gzip) Parquet."""
    return read_parquet(spark, path)


def read_ids(spark: SparkSession, path: str, schema: T.StructType = ID_SCHEMA) -> DataFrame:
    """Id list written as CSV with a header; typed by an explicit schema, no inference."""
    return spark.read.schema(schema).option("header", "true").csv(path)


RESPONSE_SCHEMA = T.StructType([
    T.StructField("status", T.IntegerType(), True),
    T.StructField("body", T.StringType(), True),
])


def read_responses(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Landed HTTP responses as ``(status INT, body STRING)``.

    ``parquet`` / ``json`` (JSON lines with ``status`` and ``body``) are read
    with the fixed schema, no inference; ``text`` takes one body per line with
    status 200 (a dump of successful responses). Files are split across tasks
    by Spark as usual.
    """
    if fmt == "parquet":
        df = spark.read.parquet(path)
        return df.select(*[df[f.name].cast(f.dataType).alias(f.name)
                           for f in RESPONSE_SCHEMA.fields])
    if fmt == "json":
        return spark.read.schema(RESPONSE_SCHEMA).json(path)
    if fmt == "text":
        return spark.read.text(path).select(F.lit(200).alias("status"),
                                            F.col("value").alias("body"))
    raise ValueError(f"unknown response format {fmt!r}; use parquet, json or text")


def text_frame(spark: SparkSession, lines: Iterable[str], column: str = "text") -> DataFrame:
    """A small in-memory text dataset (one row per line), e.g. for smoke runs."""
    schema = T.StructType([T.StructField(column, T.StringType(), True)])
    return spark.createDataFrame([(line,) for line in lines], schema)
