"""File sinks. Spark writes one file per task, in parallel, with a commit protocol."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_parquet(df: DataFrame, path: str, compression: str = "gzip", mode: str = "overwrite",
                  partition_by: list[str] | None = None) -> None:
    """Land a table as Parquet (gzip by default, like the original landing file)."""
    writer = df.write.mode(mode).option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite") -> None:
    """CSV with a header row and no index column."""
    df.write.mode(mode).option("header", str(header).lower()).csv(path)
