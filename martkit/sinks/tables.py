"""Replacing a table without a moment in which it is empty: stage, then swap.

A path or JDBC overwrite deletes the old rows before it writes the new ones, so
a job that dies meanwhile leaves nothing. Here the rows are first written to a
table of their own; only when that has ended is its name, or its location,
exchanged for the old one's. The exchange is a catalog statement.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ..sources.jdbc import driver_class, jdbc_url
from ..session import env_secret
from ..spec import JdbcConf
from .jdbc import bounded_writers

_STAGED, _OLD = "__staged_", "__old_"


def _fresh(table: str, mark: str) -> str:
    return f"{table}{mark}{uuid.uuid4().hex[:12]}"


def swap_statements(table: str, staged: str, exists: bool, old: str) -> list[str]:
    """The statements that put ``staged`` in the place of ``table``."""
    name = table.split(".")[-1]
    to = lambda new: new.split(".")[-1] if table.count(".") > 1 else new
    out = [f"ALTER TABLE {table} RENAME TO {to(old)}"] if exists else []
    out.append(f"ALTER TABLE {staged} RENAME TO {name if table.count('.') > 1 else table}")
    return out + ([f"DROP TABLE {old}"] if exists else [])


def _swap(spark: SparkSession, table: str, staged: str) -> None:
    exists = spark.catalog.tableExists(table)
    for statement in swap_statements(table, staged, exists, _fresh(table, _OLD)):
        spark.sql(statement)
    spark.catalog.refreshTable(table)


def replace_tables(frames: Mapping[str, DataFrame], fmt: str = "parquet") -> None:
    """Replace catalog tables by ``frames``: all are staged before the first is swapped.

    If a write fails, nothing is swapped and every old table stays readable; the
    staged ones are dropped. A frame may read the table that it replaces. What
    remains are the renames, two for each table: a driver that dies between them
    leaves the old table as ``<table>__old_<id>`` and the new one as
    ``<table>__staged_<id>``, from which ``recover_table`` restores the name.
    """
    staged: dict[str, str] = {}
    spark = None
    try:
        for table, df in frames.items():
            spark = df.sparkSession
            staged[table] = _fresh(table, _STAGED)
            df.write.format(fmt).saveAsTable(staged[table])
    except BaseException:
        for name in staged.values():
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        raise
    for table, name in staged.items():
        _swap(spark, table, name)


def replace_table(df: DataFrame, table: str, fmt: str = "parquet") -> None:
    """``replace_tables`` for one table."""
    replace_tables({table: df}, fmt)


def recover_table(spark: SparkSession, table: str) -> str | None:
    """Restore ``table`` after a swap that was cut short: the staged table, which is
    whole by then, gets the name. Returns what it was called, or None if the table
    is there."""
    if spark.catalog.tableExists(table):
        return None
    prefix, _, name = table.rpartition(".")
    found = [t.name for t in spark.catalog.listTables(prefix or None)]
    for mark in (_STAGED, _OLD):
        kept = [n for n in found if n.startswith(name.lower() + mark)]
        if len(kept) == 1:
            whole = f"{prefix}.{kept[0]}" if prefix else kept[0]
            spark.sql(f"ALTER TABLE {whole} RENAME TO {table}")
            return kept[0]
    raise ValueError(f"no single staged or old copy of {table!r} among {sorted(found)}")


def publish_table(df: DataFrame, table: str, root: str, fmt: str = "parquet") -> str:
    """Write ``df`` to a new folder under ``root`` and point external ``table`` there.

    One catalog statement makes the new rows visible (two if the columns change);
    the old folder stays, for readers that still use it, until it is cleaned up.
    Returns the new folder.
    """
    spark = df.sparkSession
    path = f"{root.rstrip('/')}/{table.split('.')[-1]}-{uuid.uuid4().hex[:12]}"
    df.write.format(fmt).save(path)
    exists = spark.catalog.tableExists(table)
    if exists and [(f.name, f.dataType) for f in spark.table(table).schema] == [
            (f.name, f.dataType) for f in df.schema]:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
    else:
        if exists:  # an external table: its folder stays
            spark.sql(f"DROP TABLE {table}")
        spark.sql(f"CREATE TABLE {table} USING {fmt} LOCATION '{path}'")
    spark.catalog.refreshTable(table)
    return path


def jdbc_catalog_conf(conf: JdbcConf, name: str) -> dict[str, str]:
    """Session settings that make a database a Spark catalog of this name."""
    key = f"spark.sql.catalog.{name}"
    out = {key: "org.apache.spark.sql.execution.datasources.v2.jdbc.JDBCTableCatalog",
           f"{key}.url": jdbc_url(conf), f"{key}.driver": driver_class(conf.rdbms)}
    if conf.user:
        out[f"{key}.user"] = conf.user
    password = env_secret(conf.password_env)
    if password is not None:
        out[f"{key}.password"] = password
    return out


def replace_jdbc_table(df: DataFrame, conf: JdbcConf, table: str, num_partitions: int = 8,
                       catalog: str = "martkit_jdbc") -> None:
    """Stage then swap in a database, through Spark's JDBC catalog.

    ``table`` is ``schema.table``. Not exercised against a database here; its
    statements and settings are unit-tested.
    """
    spark = df.sparkSession
    for key, value in jdbc_catalog_conf(conf, catalog).items():
        spark.conf.set(key, value)
    target = f"{catalog}.{table}"
    staged = _fresh(target, _STAGED)
    try:
        bounded_writers(df, num_partitions).writeTo(staged).create()
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {staged}")
        raise
    old = _fresh(target, _OLD)
    for statement in swap_statements(target, staged, spark.catalog.tableExists(target), old):
        spark.sql(statement)
