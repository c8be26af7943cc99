"""Warehouse shaping: dimension extraction and the flat → star split."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Outputs


def dim_distinct(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Unique combinations of ``columns``; nulls group together.

    The key is not guaranteed unique: a renamed member gives two rows, exactly
    like ``select(id, name).distinct()``. ``distinct`` plans as a partial
    aggregate before the shuffle, so a hot member is collapsed map-side.
    """
    return df.select(*columns).distinct()


def star_split(
    flat: DataFrame,
    fact_columns: Sequence[str],
    dims: Mapping[str, Sequence[str]],
    fact_name: str = "fact",
) -> Outputs:
    """Split one flat table into a fact and its dimensions.

    The outputs are lazy plans by name. Straight from a columnar source each
    reads only its own columns (a dimension reads two), so writing all of them
    costs about one fact scan. Where the flat table is costly to compute (joins,
    parsed JSON) or row-oriented (JDBC), write them inside ``with``: it is then
    computed once, persisted (or checkpointed) as columns, and each output
    reads its own of those; a dimension's ``distinct`` is still collapsed per
    task before it moves.
    """
    outputs = {fact_name: list(fact_columns), **{n: list(c) for n, c in dims.items()}}
    for name, cols in outputs.items():
        missing = [c for c in cols if c not in flat.columns]
        if missing:
            raise ValueError(f"{name}: columns {missing} not in the flat table")
    return Outputs({"flat": lambda _: flat}, lambda held: {
        fact_name: lambda: held["flat"].select(*fact_columns),
        **{n: (lambda cols=c: dim_distinct(held["flat"], cols)) for n, c in dims.items()}})


def unique_key_violations(dim: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once in a dimension (they fan joins out).

    Optional check; the default pipelines keep the fan-out, as the original does.
    """
    return dim.groupBy(key).count().filter("count > 1")


def require_unique_key(dim: DataFrame, key: str) -> DataFrame:
    """Fail fast if ``key`` is not unique in ``dim``; return ``dim`` unchanged.

    One grouped job that stops at the first duplicate found (``limit(1)``).
    """
    dup = unique_key_violations(dim, key).limit(1).collect()
    if dup:
        raise ValueError(f"dimension key {key!r} is not unique, e.g. {dup[0][key]!r} "
                         f"occurs {dup[0]['count']} times")
    return dim


def drop_duplicate_facts(fact: DataFrame, key: str) -> DataFrame:
    """Keep one row per ``key`` (opt-in; the original keeps duplicates).

    The smallest row by all columns in order stays, so every plan over the
    result keeps the same one. Rows with a null key are no copies of each other
    and all stay. A partial aggregate before the shuffle collapses a key with
    very many copies per task first.
    """
    least = fact.filter(F.col(f"`{key}`").isNotNull()).groupBy(F.col(f"`{key}`").alias("__key")).agg(
        F.min(F.struct(*[F.col(f"`{c}`") for c in fact.columns])).alias("__row"))
    return least.select("__row.*").unionByName(fact.filter(F.col(f"`{key}`").isNull()))
