"""Relational databases through Spark's JDBC data source.

Not exercised against a live database in this repository (no server may be
started here and no driver jars for PostgreSQL/MySQL/SQLite are available
offline); option construction and bound derivation are unit-tested.
"""

from __future__ import annotations

import datetime
from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import env_secret
from ..spec import JdbcConf

# JDBC driver classes per database name.
DRIVERS = {
    "postgresql": "org.postgresql.Driver",
    "mysql": "com.mysql.cj.jdbc.Driver",
    "sqlite": "org.sqlite.JDBC",
    "derby": "org.apache.derby.jdbc.EmbeddedDriver",
}
DEFAULT_PORTS = {"postgresql": 5432, "mysql": 3306}


def driver_class(rdbms: str) -> str:
    """Driver class for ``rdbms``; an unknown name is an error, not a silent gap."""
    key = rdbms.strip().lower()
    if key not in DRIVERS:
        raise ValueError(f"unsupported database {rdbms!r}; known: {sorted(DRIVERS)}")
    return DRIVERS[key]


def jdbc_url(conf: JdbcConf) -> str:
    if conf.url:
        return conf.url
    rdbms = conf.rdbms.strip().lower()
    if rdbms == "sqlite":
        return f"jdbc:sqlite:{conf.database}"
    if rdbms == "derby":
        return f"jdbc:derby:{conf.database}"
    port = conf.port or DEFAULT_PORTS.get(rdbms)
    host = f"{conf.host}:{port}" if port else conf.host
    return f"jdbc:{rdbms}://{host}/{conf.database}"


def jdbc_options(conf: JdbcConf, table: str) -> dict[str, str]:
    """Reader/writer options for one table; the password comes from the environment."""
    opts = {"url": jdbc_url(conf), "driver": driver_class(conf.rdbms), "dbtable": table}
    if conf.user:
        opts["user"] = conf.user
    password = env_secret(conf.password_env)
    if password is not None:
        opts["password"] = password
    opts.update(conf.extra)
    return opts


def bounds_from(df: DataFrame, column: str) -> tuple:
    """(min, max) of ``column`` of an already loaded frame (one aggregate)."""
    row = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi")).first()
    return row["lo"], row["hi"]


def bounds_query(table: str, column: str) -> str:
    """A ``dbtable`` subquery that makes the database compute the bounds."""
    return f"(SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}) martkit_bounds"


@dataclass(frozen=True)
class Partitioning:
    """How one table is read in parallel: by equi-depth ranges of ``column``.

    The column may be of any ordered type (numbers, strings, dates); ``parts`` is
    the number of ranges, and of connections at once.
    """

    column: str
    parts: int

    @classmethod
    def parse(cls, text: str, parts: int) -> "Partitioning":
        """``COLUMN`` or ``COLUMN:PARTS``."""
        column, _, n = text.partition(":")
        if not column or (n and not n.isdigit()) or (n and int(n) < 1):
            raise ValueError(f"expected COLUMN[:PARTS], got {text!r}")
        return cls(column, int(n) if n else parts)


def quantile_query(table: str, column: str, parts: int) -> str:
    """A ``dbtable`` subquery that makes the database compute the lowest value of
    each of ``parts`` ranges that hold equally many rows."""
    return (f"(SELECT MIN(k) AS low FROM (SELECT {column} AS k, NTILE({int(parts)}) OVER "
            f"(ORDER BY {column}) AS part FROM {table} WHERE {column} IS NOT NULL) t "
            f"GROUP BY part) martkit_quantiles")


def sql_literal(value, rdbms: str) -> str:
    """A value read from the database as a literal of its SQL."""
    if isinstance(value, bool) or value is None:
        raise ValueError(f"no range bound: {value!r}")
    if isinstance(value, (int, float, Decimal)):
        return str(value)
    if isinstance(value, datetime.datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, datetime.date):
        return f"DATE '{value.isoformat()}'"
    text = str(value)
    if rdbms.strip().lower() == "mysql":  # there a backslash escapes, too
        text = text.replace("\\", "\\\\")
    return "'" + text.replace("'", "''") + "'"


def range_predicates(column: str, lows: Sequence, rdbms: str) -> list[str]:
    """Disjoint predicates that cover every row, one range from each low to the next.

    ``lows`` are the ranges' lowest values. A value that fills several ranges
    gets one of its own: a range never splits a value. Nulls and whatever was
    written below the first low since go to the first range.
    """
    edges = sorted(set(lows))[1:]
    if not edges:
        return ["1 = 1"]
    marks = [sql_literal(e, rdbms) for e in edges]
    middle = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(marks, marks[1:])]
    return [f"{column} < {marks[0]} OR {column} IS NULL", *middle, f"{column} >= {marks[-1]}"]


def read_jdbc(
    spark: SparkSession,
    conf: JdbcConf,
    table: str,
    partition_column: str | None = None,
    num_partitions: int | None = None,
    bounds: tuple | None = None,
    predicates: Sequence[str] | None = None,
    single_partition: bool = False,
    fetchsize: int = 10_000,
    partitioning: Partitioning | None = None,
) -> DataFrame:
    """Scan a table in parallel.

    By equi-depth ranges (``partitioning``): the database computes quantiles of the
    column, any ordered type, and each range is one task; at most ``parts`` values
    reach the driver. Or a numeric/date/timestamp ``partition_column`` (bounds derived from
    min/max when not given; bounds only set the stride, every row is read and
    nulls land in the first range), or explicit ``predicates`` (one task each,
    for any key type). A one-task scan must be asked for with
    ``single_partition=True``.

    Choose a unique column (the row id), not a join key: ranges
    split the key space, never one key value, so a brand holding a third of
    the rows would put a third of the table into one task.
    """
    opts = jdbc_options(conf, table)
    opts["fetchsize"] = str(fetchsize)
    if partitioning:
        probe = {**opts, "dbtable": quantile_query(table, partitioning.column, partitioning.parts)}
        lows = [r[0] for r in spark.read.format("jdbc").options(**probe).load().collect()]
        predicates = range_predicates(partitioning.column, lows, conf.rdbms)
    if predicates:
        return spark.read.jdbc(opts.pop("url"), opts.pop("dbtable"),
                               predicates=list(predicates), properties=opts)
    if partition_column:
        if num_partitions is None or num_partitions < 1:
            raise ValueError("num_partitions is required with partition_column")
        if bounds is None:
            # MIN/MAX run inside the database; only one row comes back.
            probe_opts = {**opts, "dbtable": bounds_query(table, partition_column)}
            row = spark.read.format("jdbc").options(**probe_opts).load().first()
            bounds = (row[0], row[1])
        lo, hi = bounds
        if lo is None:  # empty table (or only nulls): one range reads everything
            lo, hi, num_partitions = 0, 1, 1
        if lo == hi:
            num_partitions = 1
            hi = lo + 1 if isinstance(lo, int) else hi
        opts.update({
            "partitionColumn": partition_column,
            "lowerBound": str(lo),
            "upperBound": str(hi),
            "numPartitions": str(num_partitions),
        })
        return spark.read.format("jdbc").options(**opts).load()
    if not single_partition:
        raise ValueError(
            "an unpartitioned JDBC scan runs as one task; give partition_column, "
            "predicates, or single_partition=True"
        )
    return spark.read.format("jdbc").options(**opts).load()
