"""Grouped aggregates with optional WHERE and HAVING, alone or several at once.

Aggregates are ordinary Catalyst aggregate expressions, so count/sum/avg plan
as partial (map-side) aggregation before the shuffle: a group key holding a
third of all rows is reduced to one row per task before it moves.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Mapping, Sequence

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..spec import AggSpec, Expr, Measure
from .cache import reliable_checkpoint
from .filter import filter_optional, quiet_analysis, to_column


def _cols(exprs: Iterable[Expr]) -> list[Column]:
    return [to_column(e) for e in exprs]


def _blank(expr: Expr | None) -> bool:
    return expr is None or (isinstance(expr, str) and not expr.strip())


def _output_names(df: DataFrame, keys: Sequence[Expr], aggs: Sequence[Expr]) -> tuple[list[str], list[str]]:
    """Names Spark gives the key and aggregate columns (analysis only, no job)."""
    cols = df.groupBy(*_cols(keys)).agg(*_cols(aggs)).columns
    return cols[: len(keys)], cols[len(keys):]


def resolves_on(df: DataFrame, predicate: Expr) -> bool:
    """Whether ``predicate`` analyses against ``df``'s columns (no job runs)."""
    try:
        with quiet_analysis():
            df.filter(to_column(predicate))
        return True
    except AnalysisException:
        return False


def computes_on(df: DataFrame, expr: Expr) -> bool:
    """Whether ``expr`` uses ``df``'s own columns only.

    Stricter than ``resolves_on``: a filter may reach columns below a
    projection, which a select may not.
    """
    try:
        with quiet_analysis():
            df.select(to_column(expr))
        return True
    except AnalysisException:
        return False


def aggregate(
    df: DataFrame,
    keys: Sequence[Expr],
    aggs: Sequence[Expr],
    where: Expr | None = None,
    having: Expr | None = None,
) -> DataFrame:
    """``SELECT keys, aggs FROM df WHERE where GROUP BY keys HAVING having``.

    Output: the group keys first, then the aggregates. ``having`` may use the
    output names (aliases, keys) or aggregate expressions that are not in the
    output (``count(id) > 5``): a filter directly on an aggregate is resolved
    by Spark as HAVING, the extra aggregate is computed in the same pass.
    """
    if isinstance(keys, (str, Column)):
        keys = [keys]
    if isinstance(aggs, (str, Column)):
        aggs = [aggs]
    source = filter_optional(df, where)
    grouped = source.groupBy(*_cols(keys))
    out = grouped.agg(*_cols(aggs))
    if _blank(having):
        return out
    return out.filter(to_column(having))


class SharedAggregates(Mapping):
    """Several aggregates of one input, as independent or as shared plans.

    Outside a ``with`` block each output is its own plain aggregate, built on
    first access: the best plan when only one output is needed. Inside
    ``with`` the outputs are projections of one combined aggregate that is
    persisted on entry and released on exit, so writing all outputs reads and
    shuffles the input once. The persisted frame holds one row per group and
    spec, never the input rows (``_combine`` states the one exception). After
    ``checkpointed()`` it is written to the reliable ``spark.checkpoint.dir``
    instead, so losing an executor while the outputs are written never
    re-reads the input. ``onepass`` has the outputs of the combined aggregate
    as lazy plans.
    """

    def __init__(self, df: DataFrame, specs: Sequence[AggSpec]):
        if not specs:
            raise ValueError("no aggregate specs")
        names = [s.name for s in specs]
        if len(set(names)) != len(names):
            raise ValueError(f"spec names must be unique: {names}")
        self._df = df
        self._specs = {s.name: s for s in specs}
        self._independent: dict[str, DataFrame] = {}
        self._combined: DataFrame | None = None
        self._derive = None
        self._onepass: dict[str, DataFrame] = {}
        self._active: dict[str, DataFrame] | None = None
        self._reliable = False
        self._held: DataFrame | None = None

    @property
    def combined(self) -> DataFrame:
        if self._combined is None:
            self._combined, self._derive = _combine(self._df, list(self._specs.values()))
            self._onepass = self._derive(self._combined)
        return self._combined

    def checkpointed(self) -> "SharedAggregates":
        """Inside ``with``, write the combined aggregate to the reliable
        ``spark.checkpoint.dir`` (lineage cut) instead of persisting it."""
        self._reliable = True
        return self

    @property
    def onepass(self) -> dict[str, DataFrame]:
        self.combined  # noqa: B018 - builds the outputs
        return self._onepass

    def __getitem__(self, name: str) -> DataFrame:
        if self._active is not None:
            return self._active[name]
        if name not in self._independent:
            s = self._specs[name]
            self._independent[name] = aggregate(self._df, s.keys, s.aggs, where=s.where,
                                                having=s.having)
        return self._independent[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._specs)

    def __len__(self) -> int:
        return len(self._specs)

    def __enter__(self) -> "SharedAggregates":
        if self._reliable:
            self._held = reliable_checkpoint(self.combined)
        else:
            self._held = self.combined.persist(StorageLevel.MEMORY_AND_DISK)
        self._active = self._derive(self._held)
        return self

    def __exit__(self, *exc) -> None:
        self._active = None
        if not self._reliable and self._held is not None:
            self._held.unpersist()
        self._held = None


def aggregate_many(df: DataFrame, specs: Sequence[AggSpec]) -> SharedAggregates:
    """Every spec over ``df``; see ``SharedAggregates`` for the two plan shapes."""
    return SharedAggregates(df, specs)


_TAG = "__martkit_tag"
_COMPARE = re.compile(r"(.+?)\s*(<=|>=|<>|!=|=|<|>)\s*([^<>=!]+)", re.S)


def _combine(df: DataFrame, specs: Sequence[AggSpec]):
    """One aggregate computing every spec, and a function deriving each spec
    as a projection of that aggregate (or of a checkpointed copy of it).

    Specs with the same group keys and WHERE are one grouped pass of any
    expressions. Specs that differ are one tagged pass (``_tagged``), which
    must know the input of each aggregate: ``count/sum/avg/min/max(input)``,
    optionally rounded. Only if a spec among them holds another aggregate
    is the input itself held, and each spec its own aggregate over it.
    """
    groups = {_group_of(s) for s in specs}
    if len(groups) == 1:
        return _grouped(df, specs)
    tagged = _tagged(df, specs)
    if tagged is not None:
        return tagged
    return df, lambda frame: {
        s.name: aggregate(frame, s.keys, s.aggs, where=s.where, having=s.having) for s in specs}


def _group_of(s: AggSpec) -> tuple[str, str]:
    return repr([str(k) for k in s.keys]), str(s.where) if not _blank(s.where) else ""


def _having(base: DataFrame, s: AggSpec) -> bool:
    """Whether the HAVING is over the output columns only.

    A projection on top stops Spark from reading the filter as HAVING, so the
    probe succeeds only for such predicates.
    """
    probe = base.groupBy(*_cols(s.keys)).agg(*_cols(s.aggs))
    return resolves_on(probe.select(*[F.col(f"`{c}`") for c in probe.columns]), s.having)


def _grouped(df: DataFrame, specs: Sequence[AggSpec]):
    """``_combine`` for specs of the same group keys and WHERE."""
    base = filter_optional(df, specs[0].where)
    slots = [(f"__martkit_k{j}", to_column(k)) for j, k in enumerate(specs[0].keys)]
    agg_cols: list[Column] = []
    plans = []
    for i, s in enumerate(specs):
        key_names, agg_names = _output_names(base, s.keys, s.aggs)
        internal = [f"__martkit_a{i}_{j}" for j in range(len(s.aggs))]
        agg_cols += [to_column(a).alias(n) for a, n in zip(s.aggs, internal)]
        flag = post = None
        if not _blank(s.having):
            if _having(base, s):
                post = s.having
            else:
                flag = f"__martkit_h{i}"
                agg_cols.append(to_column(s.having).alias(flag))
        plans.append((key_names, agg_names, internal, flag, post))

    combined = base.groupBy(*[c.alias(n) for n, c in slots]).agg(*agg_cols)

    def derive(frame: DataFrame) -> dict[str, DataFrame]:
        outputs: dict[str, DataFrame] = {}
        for s, (key_names, agg_names, internal, flag, post) in zip(specs, plans):
            part = frame.filter(F.col(flag)) if flag else frame
            part = part.select(
                *[F.col(slot).alias(name) for (slot, _), name in zip(slots, key_names)],
                *[F.col(n).alias(name) for n, name in zip(internal, agg_names)],
            )
            outputs[s.name] = part if post is None else part.filter(to_column(post))
        return outputs

    return combined, derive


def _tagged(df: DataFrame, specs: Sequence[AggSpec]):
    """``_combine`` for specs of different group keys or WHERE, or None if an
    aggregate among them is not a ``Measure`` of a row expression.

    Every row is expanded to one row per group set (keys and WHERE) whose WHERE
    it passes, tagged with the set and carrying that set's keys; all are grouped
    by tag and keys in one pass. The input of an aggregate is evaluated on rows
    of its own tag only, so no spec's expression meets a row that its WHERE
    leaves out. A spec without keys keeps its single row on empty input.
    """
    groups = list(dict.fromkeys(_group_of(s) for s in specs))
    by_group = {g: next(s for s in specs if _group_of(s) == g) for g in groups}
    fields: dict[str, tuple[str, Expr, object]] = {}  # key text -> slot, expression, type
    for s in by_group.values():
        for k in s.keys:
            if str(k) not in fields:
                kind = df.select(to_column(k)).schema.fields[0].dataType
                fields[str(k)] = (f"__martkit_k{len(fields)}", k, kind)

    agg_cols: list[Column] = []
    plans = []
    for i, s in enumerate(specs):
        tag = groups.index(_group_of(s))
        guard = f"{_TAG} = {tag}"
        base = filter_optional(df, s.where)
        key_names, agg_names = _output_names(base, s.keys, s.aggs)
        measures = [Measure.parse(a) for a in s.aggs]
        post = threshold = None
        if not _blank(s.having):
            if _having(base, s):
                post = s.having
            elif isinstance(s.having, str) and (m := _COMPARE.fullmatch(s.having.strip())):
                measures.append(Measure.parse(m[1]))
                threshold = f"{m[2]} {m[3]}"
            else:
                return None
        if any(m is None or not computes_on(df, m.input) for m in measures):
            return None
        slots = [f"__martkit_a{i}_{j}" for j in range(len(measures))]
        agg_cols += [F.expr(m.sql(guard)).alias(n) for m, n in zip(measures, slots)]
        plans.append((tag, key_names, agg_names, measures, slots, post, threshold))

    def row_of(tag: int, s: AggSpec) -> Column:
        own = {str(k) for k in s.keys}
        row = F.struct(F.lit(tag).alias(_TAG), *[
            (to_column(k) if text in own else F.lit(None).cast(kind)).alias(slot)
            for text, (slot, k, kind) in fields.items()])
        return row if _blank(s.where) else F.when(to_column(s.where), row)

    rows = F.array_compact(F.array(*[row_of(t, by_group[g]) for t, g in enumerate(groups)]))
    expanded = df.withColumn("__martkit_row", F.explode(rows)).select("*", "__martkit_row.*")
    combined = expanded.groupBy(_TAG, *[slot for slot, _, _ in fields.values()]).agg(*agg_cols)

    def derive(frame: DataFrame) -> dict[str, DataFrame]:
        outputs: dict[str, DataFrame] = {}
        for s, (tag, key_names, agg_names, measures, slots, post, threshold) in zip(specs, plans):
            part = frame.filter(F.col(_TAG) == tag)
            if not s.keys:  # one row at most: the aggregate of nothing where there is none
                part = part.agg(*[F.coalesce(F.max(n), F.lit(0)).alias(n) if m.fn == "count"
                                  else F.max(n).alias(n) for m, n in zip(measures, slots)])
            if threshold:
                part = part.filter(F.expr(f"{slots[-1]} {threshold}"))
            part = part.select(
                *[F.col(fields[str(k)][0]).alias(name) for k, name in zip(s.keys, key_names)],
                *[F.col(n).alias(name) for n, name in zip(slots, agg_names)])
            outputs[s.name] = part if post is None else part.filter(to_column(post))
        return outputs

    return combined, derive
