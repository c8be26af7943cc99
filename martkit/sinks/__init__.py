"""Sinks: files, relational databases, bounded console output."""

from .console import preview, run_noop, timed
from .files import write_csv, write_parquet
from .jdbc import bounded_writers, guard_overwrite, write_jdbc, write_sqlite
from .tables import (publish_table, recover_table, replace_jdbc_table, replace_table,
                     replace_tables)

__all__ = ["preview", "run_noop", "timed", "write_csv", "write_parquet",
           "bounded_writers", "guard_overwrite", "write_jdbc", "write_sqlite", "publish_table",
           "recover_table", "replace_jdbc_table", "replace_table", "replace_tables"]
