"""Shared-input helpers: persist around fan-out, checkpoint to cut lineage."""

from __future__ import annotations

from contextlib import contextmanager
from collections.abc import Iterator

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir


@contextmanager
def cached(df: DataFrame, view: str | None = None,
           level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """Persist ``df`` (optionally as a temp view) and always release it.

    Use only where two or more outputs read the same expensive input. Lost
    blocks are recomputed from lineage if an executor goes away.
    """
    df = df.persist(level)
    try:
        if view:
            df.createOrReplaceTempView(view)
        yield df
    finally:
        if view:
            df.sparkSession.catalog.dropTempView(view)
        df.unpersist()


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and cut its lineage.

    Reads ``spark.checkpoint.dir`` from the session (a local folder is chosen
    only for local sessions). Survives executor loss, unlike a local checkpoint.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def set_shuffle_partitions(spark: SparkSession, n: int) -> None:
    """Fixed shuffle width (the original V1 job used 4); AQE still coalesces."""
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
