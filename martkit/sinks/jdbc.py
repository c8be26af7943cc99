"""Writing tables to relational databases through Spark's JDBC data source.

Not exercised against a live database here (see ``sources/jdbc.py``).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from ..sources.jdbc import jdbc_options, jdbc_url
from ..spec import JdbcConf


def _same_table(a: str, b: str) -> bool:
    """Whether two names may mean one table; a name without a schema may be in any."""
    x, y = ([p.strip().strip('"`').lower() for p in n.split(".")] for n in (a, b))
    short = min(len(x), len(y))
    return x[-short:] == y[-short:]


def _same_database(a: JdbcConf, b: JdbcConf) -> bool:
    return jdbc_url(a).lower() == jdbc_url(b).lower()


def guard_overwrite(conf: JdbcConf, table: str, sources: Iterable[tuple[JdbcConf, str]]) -> None:
    """Refuse to overwrite a table the same plan reads.

    Spark truncates/drops the target before the lazy read happens, so the
    table would come back empty.
    """
    for src_conf, src_table in sources:
        if _same_database(src_conf, conf) and _same_table(src_table, table):
            raise ValueError(f"refusing to overwrite {table!r}: it is also an input of this plan")


def bounded_writers(df: DataFrame, num_partitions: int) -> DataFrame:
    """``df`` in exactly ``num_partitions`` partitions: one connection each.

    Spark's JDBC writer limits connections with ``coalesce``, which is not a
    shuffle: when the plan has no shuffle of its own (a scan, a filter, a
    broadcast join), the whole upstream stage would shrink to that many
    tasks. A round-robin repartition keeps the upstream at full width and
    moves each row once more; the database, not the shuffle, limits a JDBC
    write. Round-robin is deterministic (rows are sorted locally first), so
    a retried task sends the same rows to the same writer.
    """
    if num_partitions < 1:
        raise ValueError("num_partitions must be at least 1")
    return df.repartition(num_partitions)


def write_jdbc(
    df: DataFrame,
    conf: JdbcConf,
    table: str,
    mode: str = "overwrite",
    sources: Iterable[tuple[JdbcConf, str]] = (),
    num_partitions: int = 8,
    batchsize: int = 10_000,
    truncate: bool = False,
) -> None:
    """Write ``df`` to ``table`` (``overwrite`` replaces it).

    At most ``num_partitions`` concurrent connections (``bounded_writers``),
    each inserting in ``batchsize`` batches, so a large cluster does not flood
    the database while the plan before the write keeps its full width.
    """
    if mode == "overwrite":
        guard_overwrite(conf, table, sources)
    opts = jdbc_options(conf, table)
    opts.update({"numPartitions": str(num_partitions), "batchsize": str(batchsize)})
    if truncate:
        opts["truncate"] = "true"
    bounded_writers(df, num_partitions).write.format("jdbc").mode(mode).options(**opts).save()


def write_sqlite(df: DataFrame, path: str, table: str, mode: str = "overwrite",
                 sources: Iterable[tuple[JdbcConf, str]] = ()) -> None:
    """SQLite file target (needs the SQLite JDBC jar); one writer, SQLite has one lock."""
    conf = JdbcConf(rdbms="sqlite", database=path)
    write_jdbc(df, conf, table, mode=mode, sources=sources, num_partitions=1)
