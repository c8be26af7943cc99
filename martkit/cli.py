"""Command-line jobs: the same job shapes the original pipelines submit.

    python -m martkit <job> [options]

Jobs: ``join`` (2-way), ``multi-join`` (join program), ``agg`` (filter, group,
aggregate, having), ``join-agg`` (join once, several aggregates), ``dwh``
(flat → star), ``ingest`` (raw product responses → flat), ``wordcount``, and
``run`` (a whole V1/V2/V3 run from the flat table in one application).

Tables live in a *store*: ``--store parquet:/dir`` (table ``t`` is
``/dir/t`` or ``/dir/t.parquet``), ``--store catalog:db`` (tables of the session
catalog, replaced by stage and swap) or ``--store jdbc`` with ``--rdbms``,
``--host``, ``--port``, ``--database``, ``--user`` and ``--password-env``
(the *name* of an environment variable holding the password). JDBC tables are
read in parallel by equi-depth ranges of the column that ``--partition
TABLE=COLUMN[:PARTS]`` names for each. Outputs go to ``--out-store`` (default: the
input store). Each job is one lazy plan executed by its writes.
"""

from __future__ import annotations

import argparse
import json
import os
import sys
from contextlib import nullcontext
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from .functions.text import word_count
from .operators.aggregate import aggregate, aggregate_many
from .operators.joins import Table, join_program, join_using
from .plans.pipelines import REFERENCE, pipeline_v1, pipeline_v2, pipeline_v3, warehouse
from .session import build_session
from .sinks.console import preview, timed
from .sinks.files import write_parquet
from .sinks.jdbc import write_jdbc, write_sqlite
from .sinks.tables import replace_jdbc_table, replace_table
from .sources.documents import flatten_products
from .sources.files import deal_out, read_parquet, read_responses, text_frame
from .sources.jdbc import Partitioning, read_jdbc
from .spec import AggSpec, JdbcConf, JoinStep, split_list


@dataclass
class Store:
    kind: str
    root: str | None = None
    conf: JdbcConf | None = None
    partition_column: str | None = None
    num_partitions: int | None = None
    partitions: dict[str, str] = field(default_factory=dict)  # table -> COLUMN[:PARTS]
    write_partitions: int = 8
    staged: bool = False

    def partitioning(self, table: str, default: int) -> Partitioning | None:
        """How a table is read: its own column, else the one given for all tables."""
        spec = self.partitions.get(table) or self.partition_column
        return Partitioning.parse(spec, self.num_partitions or default) if spec else None

    def path(self, spark: SparkSession, table: str) -> str:
        """The fully qualified path of a table: ``t`` or, if only that exists, ``t.parquet``."""
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        plain = jvm.org.apache.hadoop.fs.Path(os.path.join(self.root, table))
        fs = plain.getFileSystem(conf)
        named = jvm.org.apache.hadoop.fs.Path(os.path.join(self.root, table + ".parquet"))
        found = named if not fs.exists(plain) and fs.exists(named) else plain
        return fs.makeQualified(found).toString()

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        if self.kind == "parquet":
            return read_parquet(spark, self.path(spark, table))
        if self.kind == "catalog":
            return spark.table(self.table(table))
        partitioning = self.partitioning(table, spark.sparkContext.defaultParallelism)
        if partitioning:
            return read_jdbc(spark, self.conf, table, partitioning=partitioning)
        print(f"martkit: reading {table!r} in one task; give --partition {table}=COLUMN "
              "to read in parallel", file=sys.stderr)
        return read_jdbc(spark, self.conf, table, single_partition=True)

    def table(self, table: str) -> str:
        return f"{self.root}.{table}" if self.root else table

    def write(self, df: DataFrame, table: str, sources: list[tuple["Store", str]]) -> None:
        spark = df.sparkSession
        jdbc_sources = [(s.conf, n) for s, n in sources if s.kind == "jdbc"]
        if self.kind == "parquet":
            target = self.path(spark, table)
            for store, name in sources:
                if store.kind == "parquet" and store.path(spark, name) == target:
                    raise ValueError(f"refusing to overwrite {table!r}: it is also an input")
            write_parquet(df, target)
        elif self.kind == "catalog":
            replace_table(df, self.table(table))
        elif self.conf.rdbms == "sqlite":
            write_sqlite(df, self.conf.database, table, sources=jdbc_sources)
        elif self.staged:
            replace_jdbc_table(df, self.conf, table, self.write_partitions)
        else:
            write_jdbc(df, self.conf, table, sources=jdbc_sources,
                       num_partitions=self.write_partitions)


def _store(spec: str | None, args, prefix: str = "") -> Store:
    if spec is None:
        return None
    if spec.startswith("parquet:"):
        return Store("parquet", root=spec[len("parquet:"):])
    if spec.startswith("catalog:"):
        return Store("catalog", root=spec[len("catalog:"):])
    if spec == "jdbc":
        get = lambda k: getattr(args, prefix + k)
        conf = JdbcConf(rdbms=get("rdbms"), database=get("database"), host=get("host"),
                        port=get("port"), user=get("user"), password_env=get("password_env"))
        partitions = dict(p.split("=", 1) for p in getattr(args, "partition", None) or [])
        return Store("jdbc", conf=conf, partition_column=getattr(args, "partition_column", None),
                     num_partitions=getattr(args, "num_partitions", None), partitions=partitions,
                     write_partitions=getattr(args, "write_partitions", 8),
                     staged=getattr(args, "staged", False))
    raise ValueError(f"unknown store {spec!r}; use parquet:/dir, catalog:db or jdbc")


def _add_join_strategy_args(p: argparse.ArgumentParser) -> None:
    p.add_argument("--broadcast", choices=["left", "right"],
                   help="side that may be broadcast if a size probe proves it small")
    p.add_argument("--salt-buckets", type=int, default=0,
                   help="split off hot left keys, or spread them over this many tasks "
                        "(shuffle joins)")
    p.add_argument("--hot", help="'auto' (default: keys with >= 1%% of the left rows), "
                                 "comma-separated key values, or 'all' to salt every key")
    p.add_argument("--row-id", help="comma-separated left columns that tell its rows apart, "
                                    "hashed for the salt")
    p.add_argument("--key-filter", action="store_true",
                   help="drop left rows whose key the right side lacks before the shuffle")


def _hot_arg(text: str | None):
    """``--hot``: None, "auto", "all", or key values (integers where they parse)."""
    if text is None or text in ("auto", "all"):
        return text
    values = []
    for v in split_list(text):
        try:
            values.append(int(v))
        except ValueError:
            values.append(v.strip("'\""))
    return values


def _add_store_args(p: argparse.ArgumentParser) -> None:
    p.add_argument("--store", required=True, help="parquet:/dir, catalog:db or jdbc")
    p.add_argument("--out-store", help="parquet:/dir, catalog:db or jdbc (default: --store)")
    for prefix in ("", "out_"):
        dash = prefix.replace("_", "-")
        p.add_argument(f"--{dash}rdbms", dest=f"{prefix}rdbms", default="postgresql")
        p.add_argument(f"--{dash}host", dest=f"{prefix}host", default="localhost")
        p.add_argument(f"--{dash}port", dest=f"{prefix}port", type=int)
        p.add_argument(f"--{dash}database", dest=f"{prefix}database")
        p.add_argument(f"--{dash}user", dest=f"{prefix}user")
        p.add_argument(f"--{dash}password-env", dest=f"{prefix}password_env")
    p.add_argument("--partition", action="append", metavar="TABLE=COLUMN[:PARTS]",
                   help="column for parallel JDBC reads of one table, by equi-depth ranges")
    p.add_argument("--partition-column", help="the same for every table without --partition")
    p.add_argument("--num-partitions", type=int, help="ranges where PARTS is not given")
    p.add_argument("--write-partitions", type=int, default=8,
                   help="connections of a JDBC write")
    p.add_argument("--staged", action="store_true",
                   help="JDBC writes: stage the rows and swap the tables' names")
    p.add_argument("--shuffle-partitions", type=int)
    p.add_argument("--master")
    p.add_argument("--preview", action="store_true", help="print 10 rows after writing")


def build_parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="martkit", description=__doc__,
                                 formatter_class=argparse.RawDescriptionHelpFormatter)
    sub = ap.add_subparsers(dest="job", required=True)

    p = sub.add_parser("join", help="two tables, optional filters, one USING join")
    _add_store_args(p)
    p.add_argument("--left", required=True)
    p.add_argument("--left-filter", default="")
    p.add_argument("--right", required=True)
    p.add_argument("--right-filter", default="")
    p.add_argument("--on", required=True)
    p.add_argument("--how", default="inner")
    _add_join_strategy_args(p)
    p.add_argument("--output", required=True)

    p = sub.add_parser("multi-join", help="n filtered tables, m join steps")
    _add_store_args(p)
    p.add_argument("--table", nargs=2, action="append", metavar=("NAME", "FILTER"), required=True)
    p.add_argument("--step", action="append", default=[], help='"left right column [how]"')
    p.add_argument("--broadcast", choices=["left", "right"],
                   help="side of every step that may be broadcast after a size probe")
    p.add_argument("--salt-buckets", type=int, default=0,
                   help="spread hot left keys of every shuffle step over this many tasks")
    p.add_argument("--hot", choices=["auto", "all"], help="which keys (default: auto)")
    p.add_argument("--key-filter", action="store_true",
                   help="drop left rows of a step whose key its right side lacks")
    p.add_argument("--output", required=True)

    p = sub.add_parser("agg", help="filter, group, aggregate, having")
    _add_store_args(p)
    p.add_argument("--input", required=True)
    p.add_argument("--filter", default="")
    p.add_argument("--aggregations", required=True)
    p.add_argument("--group", required=True)
    p.add_argument("--having", default="")
    p.add_argument("--output", required=True)

    p = sub.add_parser("join-agg", help="one join, several aggregates from one pass")
    _add_store_args(p)
    p.add_argument("--left", required=True)
    p.add_argument("--left-filter", default="")
    p.add_argument("--right", required=True)
    p.add_argument("--right-filter", default="")
    p.add_argument("--on", required=True)
    p.add_argument("--how", default="inner")
    _add_join_strategy_args(p)
    p.add_argument("--output", nargs=4, action="append", required=True,
                   metavar=("TABLE", "AGGREGATIONS", "GROUP", "HAVING"))

    p = sub.add_parser("dwh", help="flat table → product, brand, category")
    _add_store_args(p)
    p.add_argument("--input", required=True)
    p.add_argument("--checkpoint", action="store_true",
                   help="write a JDBC input once to spark.checkpoint.dir instead of persisting")

    p = sub.add_parser("ingest", help="raw product responses (status, body) → flat table")
    _add_store_args(p)
    p.add_argument("--input", required=True)
    p.add_argument("--output", default="product_data")
    p.add_argument("--rejected", default="product_data_rejected")
    p.add_argument("--format", choices=["table", "parquet", "json", "text"], default="table",
                   help="'table': a (status, body) table in the store; otherwise a file path")
    p.add_argument("--tasks", type=int, default=0,
                   help="deal the rows of fewer files than this over so many tasks")
    p.add_argument("--checkpoint", action="store_true",
                   help="write the judged documents to spark.checkpoint.dir instead of persisting")

    p = sub.add_parser("run", help="flat table → star tables → every V1/V2/V3 output")
    _add_store_args(p)
    p.add_argument("--version", choices=["v1", "v2", "v3"], required=True)
    p.add_argument("--input", default="product_data")
    p.add_argument("--join-first", action="store_true",
                   help="aggregate after the joins instead of pre-aggregating the fact")
    p.add_argument("--checkpoint", action="store_true",
                   help="checkpoint the shared partial (and a JDBC input) to "
                        "spark.checkpoint.dir instead of persisting")

    p = sub.add_parser("wordcount", help="count space-separated tokens of a text column")
    _add_store_args(p)
    p.add_argument("--input", help="table with a text column")
    p.add_argument("--text", action="append", help="literal line(s) instead of --input")
    p.add_argument("--column", default="text")
    p.add_argument("--drop-trailing-empty", action="store_true")
    p.add_argument("--output", help="table to write; needed with --input, else all pairs are printed")
    return ap


def run(argv: list[str] | None = None) -> dict:
    args = build_parser().parse_args(argv)
    spark = build_session(args.master, app_name=f"martkit-{args.job}",
                          shuffle_partitions=args.shuffle_partitions)
    src = _store(args.store, args)
    dst = _store(args.out_store, args, "out_") or src
    read = lambda name: src.read(spark, name)
    written: dict[str, float] = {}

    def write(df: DataFrame, table: str, inputs: list[str], store: Store | None = None) -> None:
        _, sec = timed(lambda: dst.write(df, table, [(store or src, n) for n in inputs]))
        written[table] = round(sec, 3)
        if args.preview:
            preview(df if dst.kind == "jdbc" else dst.read(spark, table))

    def write_star(flat: DataFrame, roles) -> None:
        # A row-oriented source (JDBC) would be re-read in full by each of the
        # three outputs: it is read once, persisted or with --checkpoint written to
        # spark.checkpoint.dir (a lost executor then never re-queries the
        # database, and all three outputs see one snapshot of it). Parquet
        # outputs read only their own columns, so nothing is cached there.
        star = warehouse(flat, roles)
        if args.checkpoint:
            star = star.checkpointed()
        with star if src.kind == "jdbc" else nullcontext(star):
            for name in star:
                write(star[name], name, [args.input])

    def strategy() -> dict:
        return {"broadcast": args.broadcast, "salt_buckets": args.salt_buckets,
                "hot": _hot_arg(args.hot), "key_filter": args.key_filter,
                "row_id": split_list(args.row_id) if args.row_id else None}

    if args.job == "join":
        df = join_using(read(args.left), read(args.right), args.on, args.how,
                        left_filter=args.left_filter, right_filter=args.right_filter,
                        **strategy())
        write(df, args.output, [args.left, args.right])
    elif args.job == "multi-join":
        tables = [Table(read(name), flt) for name, flt in args.table]
        steps = [JoinStep.parse(s) for s in args.step]
        df = join_program(tables, steps, broadcast=[args.broadcast] * len(steps),
                          salt_buckets=args.salt_buckets, hot=args.hot,
                          key_filter=args.key_filter)
        write(df, args.output, [name for name, _ in args.table])
    elif args.job == "agg":
        df = aggregate(read(args.input), split_list(args.group), split_list(args.aggregations),
                       where=args.filter, having=args.having)
        write(df, args.output, [args.input])
    elif args.job == "join-agg":
        joined = join_using(read(args.left), read(args.right), args.on, args.how,
                            left_filter=args.left_filter, right_filter=args.right_filter,
                            **strategy())
        specs = [AggSpec.of(split_list(g), split_list(a), having=h, name=t)
                 for t, a, g, h in args.output]
        with aggregate_many(joined, specs) as outs:
            for t in outs:
                write(outs[t], t, [args.left, args.right])
    elif args.job == "dwh":
        write_star(read(args.input), REFERENCE)
    elif args.job == "ingest":
        responses = (read(args.input) if args.format == "table"
                     else read_responses(spark, args.input, args.format))
        if args.tasks:
            responses = deal_out(responses, args.tasks)
        flat = flatten_products(responses)
        with flat.checkpointed() if args.checkpoint else flat:  # parsed once for both
            write(flat.rows, args.output, [args.input])
            write(flat.rejected, args.rejected, [args.input])
    elif args.job == "run":
        roles = REFERENCE.with_(eager=not args.join_first)
        write_star(read(args.input), roles)
        # Later steps read the star tables just written, as the original does
        # between its jobs; each output is one plan over them.
        product, brand, category = (dst.read(spark, t) for t in ("product", "brand", "category"))
        tables = ["product", "brand", "category"]
        if args.version == "v1":
            outs = pipeline_v1(product, brand, roles)
        elif args.version == "v2":
            outs = pipeline_v2(product, brand, category, roles)
        else:
            outs = pipeline_v3(product, brand, category, roles)
        if args.checkpoint:
            outs = outs.checkpointed()
        with outs:
            for name in outs:
                write(outs[name], name, tables, store=dst)
    elif args.job == "wordcount":
        if args.text:
            source, inputs = text_frame(spark, args.text, args.column), []
        elif args.input:
            source, inputs = read(args.input), [args.input]
        else:
            raise SystemExit("wordcount needs --input TABLE or --text LINE")
        df = word_count(source, args.column, drop_trailing_empty=args.drop_trailing_empty)
        if args.output:
            write(df, args.output, inputs)
        elif args.text:  # every pair; the command line bounds them
            for row in df.orderBy("word").collect():
                print(row["word"], row["n"])
        else:
            raise SystemExit("wordcount of a table needs --output (use --preview to look at it)")
    report = {"job": args.job, "written_sec": written}
    print(json.dumps(report))
    return report


def main() -> None:
    run(sys.argv[1:])


if __name__ == "__main__":
    main()
