"""Projections and predicates.

All of these are plain Catalyst expressions, so filters reach the Parquet scan
as ``PushedFilters`` and projections prune the ``ReadSchema``.
"""

from __future__ import annotations

import logging
from collections.abc import Iterable, Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..spec import Expr


@contextmanager
def quiet_analysis() -> Iterator[None]:
    """Silence PySpark's error log while probing whether a plan analyses.

    A failed probe is an expected answer, not an error worth a stack trace.
    """
    loggers = [logging.getLogger(n) for n in ("SQLQueryContextLogger",
                                              "DataFrameQueryContextLogger")]
    levels = [lg.level for lg in loggers]
    for lg in loggers:
        lg.setLevel(logging.CRITICAL)
    try:
        yield
    finally:
        for lg, level in zip(loggers, levels):
            lg.setLevel(level)


def to_column(expr: Expr) -> Column:
    """A SQL-text fragment or a Column → Column."""
    if isinstance(expr, Column):
        return expr
    if isinstance(expr, str):
        return F.expr(expr)
    raise TypeError(f"expected a SQL expression string or Column, got {type(expr)!r}")


def filter_optional(df: DataFrame, predicate: Expr | None) -> DataFrame:
    """Apply ``predicate`` unless it is None or blank (the jobs' "no filter")."""
    if predicate is None:
        return df
    if isinstance(predicate, str) and not predicate.strip():
        return df
    return df.filter(to_column(predicate))


def project(df: DataFrame, columns: Iterable[Expr]) -> DataFrame:
    """Fixed column list; strings may carry ``AS`` aliases (``"x AS y"``)."""
    return df.select(*[to_column(c) if isinstance(c, str) and not _is_plain(c) else c for c in columns])


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename columns, leaving the others (and their order) as they are."""
    missing = [c for c in mapping if c not in df.columns]
    if missing:
        raise ValueError(f"cannot rename missing columns {missing}")
    return df.withColumnsRenamed(dict(mapping))


def not_in(column: str, values: Iterable) -> Column:
    """``column NOT IN (values)``; a null column value is dropped, as in SQL."""
    return ~F.col(column).isin(list(values))


def _is_plain(name: str) -> bool:
    return name.replace("_", "").isalnum()
