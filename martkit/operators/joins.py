"""Equi-joins on one shared column (USING semantics) and n-way join programs.

Output layout follows ``DataFrame.join(other, on=name)``: the key once and
first, then the left columns, then the right columns. The physical strategy is
Spark's: sort-merge with AQE (coalescing, skew splitting) by default. A side is
broadcast only when the caller names it *and* a bounded probe proves it small.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..spec import Expr, JoinStep, normalize_how
from .filter import filter_optional
from .stats import estimated_bytes

# Broadcast bounds: a side above either is joined by shuffle instead.
BROADCAST_MAX_ROWS = 4_000_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024

_SALT = "__martkit_salt"
_MET = "__martkit_met"
_PLACE, _WORD, _MASK = "__martkit_place", "__martkit_word", "__martkit_mask"


def check_join_columns(left: DataFrame, right: DataFrame, on: str, how: str) -> None:
    """Fail before running if the join cannot produce a usable table.

    Spark accepts a non-key column present on both sides, but the result then
    has it twice: selecting it is ambiguous and a JDBC write fails late.
    """
    lcols = {c.lower() for c in left.columns}
    rcols = {c.lower() for c in right.columns}
    if on.lower() not in lcols:
        raise ValueError(f"join column {on!r} not in left side {left.columns}")
    if on.lower() not in rcols:
        raise ValueError(f"join column {on!r} not in right side {right.columns}")
    if how in ("left_semi", "left_anti"):
        return
    shared = sorted((lcols & rcols) - {on.lower()})
    if shared:
        raise ValueError(
            f"columns {shared} exist on both sides of the join on {on!r}; "
            "rename or drop them first"
        )


def _row_bytes(df: DataFrame):
    """Per-row payload estimate: 8 bytes per fixed-width value, real lengths otherwise."""
    parts = []
    for field in df.schema.fields:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            parts.append(F.coalesce(F.octet_length(col), F.lit(0)))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            parts.append(F.coalesce(F.octet_length(F.to_json(col)), F.lit(0)))
        else:
            parts.append(F.lit(8))
    total = F.lit(16)  # row header
    for p in parts:
        total = total + p
    return total


def probe_frame(df: DataFrame) -> DataFrame:
    """One row: the side's row count and payload bytes.

    A plain aggregate: every task counts its own rows and sends one partial
    row. (A ``limit`` before it would plan as a single-partition exchange
    into which every task ships up to the limit in whole rows.)
    """
    return df.agg(F.count(F.lit(1)).alias("n"), F.sum(_row_bytes(df)).alias("b"))


def _probe(df: DataFrame) -> tuple[int, int]:
    row = probe_frame(df).first()
    return int(row["n"]), int(row["b"] or 0)


# Skip the probe when Catalyst's own estimate is this many times over the bound.
ESTIMATE_SKIP_FACTOR = 4


def broadcast_if_bounded(
    df: DataFrame,
    max_rows: int = BROADCAST_MAX_ROWS,
    max_bytes: int = BROADCAST_MAX_BYTES,
) -> tuple[DataFrame, bool]:
    """Hint ``broadcast`` only if the side is proven within both bounds.

    The probe counts the rows and payload bytes of the side in one aggregate
    pass; a side that turns out large costs that pass and the join stays a
    shuffle join. When Catalyst's metadata estimate is already far over the
    byte bound, no probe runs at all, so only sides estimated within a few
    times the bound are ever scanned. Every call decides afresh: a table may
    have grown since the last one. Returns the (possibly hinted) frame and the
    decision.
    """
    ok = _within_bounds(df, max_rows, max_bytes)
    return (F.broadcast(df) if ok else df), ok


def _within_bounds(df: DataFrame, max_rows: int, max_bytes: int) -> bool:
    estimate = estimated_bytes(df)
    if estimate is not None and estimate > ESTIMATE_SKIP_FACTOR * max_bytes:
        return False  # far too large: no probe scan, shuffle join
    n, b = _probe(df)
    return n <= max_rows and b <= max_bytes


def salt_column(df: DataFrame, buckets: int, row_id: Sequence[str] | None = None):
    """A deterministic bucket in ``[0, buckets)`` for every row of ``df``.

    ``row_id`` names columns that tell rows apart (an order and a line number);
    only they are hashed, so no other column is read for the salt and copies of
    a row spread wherever they stand. Without it the hash covers the whole row
    and the input partition the row is read in: distinct rows of a hot key
    spread by content, identical copies by the partition they come from, but
    copies that were shuffled on the key before stand in one partition and do
    not spread. All inputs are fixed for a given task, so a task recomputed
    after an executor loss assigns every row the same bucket again; a row
    position or ``rand`` would not be, because row order after a shuffle is not.
    """
    if row_id:
        return F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in row_id]), F.lit(buckets))
    cols = [F.col(f"`{f.name}`") for f in df.schema.fields if _hashable(f.dataType)]
    return F.pmod(F.xxhash64(F.spark_partition_id(), *cols), F.lit(buckets))


def _hashable(dtype: T.DataType) -> bool:
    """Whether ``xxhash64`` accepts the type (maps and variants it refuses)."""
    if isinstance(dtype, (T.MapType, T.VariantType)):
        return False
    if isinstance(dtype, T.ArrayType):
        return _hashable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(_hashable(f.dataType) for f in dtype.fields)
    return True


def _padded(df: DataFrame, types: Sequence[T.DataType], order: Sequence[str]) -> DataFrame:
    """``df`` with the missing ``order`` columns as typed nulls, in that order."""
    present = {c.lower() for c in df.columns}
    return df.select(*[
        F.col(f"`{c}`").alias(c) if c.lower() in present else F.lit(None).cast(t).alias(c)
        for c, t in zip(order, types)
    ])


def _named(df: DataFrame, on: str) -> str:
    """The column of ``df`` that the key ``on`` resolves to (case-insensitive)."""
    return next(c for c in df.columns if c.lower() == on.lower())


def hot_keys(df: DataFrame, on: str, min_share: float = 0.01) -> list:
    """Values of ``on`` holding at least ``min_share`` of ``df``'s rows.

    One aggregate pass: a mergeable frequent-items sketch (``approx_top_k``)
    and a row count, so every task sends one small sketch and at most
    ``1 / min_share`` values, which is as many as there can be, reach the driver. Nulls are left out (they never match; the salt
    spreads them anyway).
    """
    key = _named(df, on)
    row = df.agg(F.expr(f"approx_top_k(`{key}`, {math.ceil(1 / min_share)})").alias("top"),
                 F.count(F.lit(1)).alias("n")).first()
    return [r["item"] for r in (row["top"] or [])
            if r["item"] is not None and r["count"] >= min_share * row["n"]]


def salt_sides(left: DataFrame, right: DataFrame, on: str, buckets: int,
               hot: Sequence | None = None, row_id: Sequence[str] | None = None
               ) -> tuple[DataFrame, DataFrame]:
    """Both join inputs with a salt column: left rows get one bucket each,
    right rows one copy per bucket their key can meet (all buckets for a
    salted key, bucket 0 otherwise)."""
    lkey, rkey = _named(left, on), _named(right, on)
    zero = F.lit(0).cast("long")
    every = F.sequence(zero, F.lit(buckets - 1).cast("long"))
    if hot is None:
        left_salt, right_salts = salt_column(left, buckets, row_id), every
    else:
        lk, rk = F.col(f"`{lkey}`"), F.col(f"`{rkey}`")
        spread_left = lk.isNull() | (lk.isin(list(hot)) if hot else F.lit(False))
        left_salt = F.when(spread_left, salt_column(left, buckets, row_id)).otherwise(zero)
        right_salts = (F.when(rk.isin(list(hot)), every).otherwise(F.array(zero))
                       if hot else F.array(zero))
    return (left.withColumn(_SALT, left_salt),
            right.withColumn(_SALT, F.explode(right_salts)))


def _layout(left: DataFrame, right: DataFrame, on: str, how: str) -> list[str]:
    """USING layout: the key, the left columns, the right columns (if any are kept)."""
    lkey, rkey = _named(left, on), _named(right, on)
    kept = [] if how in ("left_semi", "left_anti") else [c for c in right.columns if c != rkey]
    return [lkey] + [c for c in left.columns if c != lkey] + kept


def _salted(left: DataFrame, right: DataFrame, on: str, how: str, buckets: int,
            hot: Sequence | None = None, row_id: Sequence[str] | None = None) -> DataFrame:
    """Spread left keys over ``buckets`` tasks; replicate their right rows.

    For a hot key holding a large share of the left rows (see ``salt_column``).
    Inner, left, semi and anti joins emit no unmatched right row, so a right
    row replicated into every bucket still matches each left row once. With
    ``hot`` given (keys that the left side holds), only those keys are spread,
    plus null keys, which never match, and only their right rows are
    replicated; every other row keeps bucket 0. Right and full joins then work
    in the same single join: a right row of a hot key has a left row in some
    bucket, so its copies that met none are dropped, and what is kept without a
    left row has a key that the left side does not hold. With every key spread
    (``hot`` None), right and full joins add the right rows whose key has no left
    row by an anti join against the left side's distinct keys, a second scan.
    The join is a sort-merge join by hint: Spark's estimate of the right side knows
    nothing of its copies, and where it lies below the broadcast threshold every task
    would hold all of them.
    """
    order = _layout(left, right, on, how)
    lkey, rkey = _named(left, on), _named(right, on)
    if how in ("right", "full") and hot is None:
        types = ([right.schema[rkey].dataType]
                 + [left.schema[c].dataType for c in left.columns if c != lkey]
                 + [right.schema[c].dataType for c in right.columns if c != rkey])
        preserved = _salted(left, right, on, "left" if how == "full" else "inner", buckets,
                            None, row_id)
        lonely_right = right.join(left.select(F.col(f"`{lkey}`")).distinct(), on=on, how="left_anti")
        return preserved.union(_padded(lonely_right, types, order))
    salted_left, salted_right = salt_sides(left, right, on, buckets, hot, row_id)
    salted_right = salted_right.hint("merge")
    if how in ("right", "full"):
        joined = salted_left.withColumn(_MET, F.lit(True)).join(salted_right, on=[on, _SALT], how=how)
        copy = F.col(_MET).isNull() & F.col(f"`{on}`").isin(list(hot)) if hot else F.lit(False)
        joined = joined.filter(~F.coalesce(copy, F.lit(False)))
    else:
        joined = salted_left.join(salted_right, on=[on, _SALT], how=how)
    return joined.select(*[F.col(f"`{c}`") for c in order])


def _split(left: DataFrame, right: DataFrame, on: str, how: str, hot: Sequence,
           max_rows: int, max_bytes: int) -> DataFrame | None:
    """Hot keys by broadcast, all others by a plain shuffle join; None if the hot
    keys' right rows are not proven small.

    For join types that emit no unmatched right row. The left side is read once
    for each part, with the keys pushed down to its scan; its hot rows are not
    shuffled at all, and no row of either side is copied.
    """
    lkey, rkey = F.col(f"`{_named(left, on)}`"), F.col(f"`{_named(right, on)}`")
    keys = list(hot)
    some, small = broadcast_if_bounded(right.filter(rkey.isin(keys)), max_rows, max_bytes)
    if not small:
        return None
    cold_left = left.filter(lkey.isNull() | ~lkey.isin(keys))
    cold_right = right.filter(~rkey.isin(keys))
    order = _layout(left, right, on, how)
    parts = [l.join(r, on=on, how=how).select(*[F.col(f"`{c}`") for c in order])
             for l, r in ((left.filter(lkey.isin(keys)), some), (cold_left, cold_right))]
    return parts[0].union(parts[1])


# A key filter has at most this many bits (2^27: 2 million rows, 32 MB of payload).
KEY_FILTER_BITS = 27
_BITS_PER_KEY = 8


def reduce_by_keys(df: DataFrame, other: DataFrame, on: str,
                   max_bits: int = KEY_FILTER_BITS) -> DataFrame:
    """The rows of ``df`` whose key ``on`` may stand in ``other``: a run-time key filter.

    For a side too large to broadcast, before ``df`` is shuffled for an inner or
    semi join with it. The hashes of the other side's keys set bits of a bitmap of
    fixed size, held as rows (word, 64 bits) that are broadcast; the filter is
    a hash join on the word and a bit test, all in the JVM. Rows with other
    hashes and null keys go; false positives (about one in eight) stay and are
    dropped by the join itself. One aggregate counts the other side's distinct
    keys to size the bitmap; where it would need more than 2^``max_bits`` bits
    the filter is left out, which changes the plan but no row. So it is for keys
    whose equality is not that of their text (floating point, decimals).
    """
    kinds = [f.schema[_named(f, on)].dataType for f in (df, other)]
    exact = (T.StringType, T.DateType, T.TimestampType, T.BooleanType)
    if not (all(isinstance(k, T.IntegralType) for k in kinds)
            or kinds[0] == kinds[1] and isinstance(kinds[0], exact)):
        return df
    okey = F.col(f"`{_named(other, on)}`")
    distinct = other.agg(F.approx_count_distinct(okey).alias("n")).first()["n"]
    bits = max(10, math.ceil(math.log2(max(1, distinct) * _BITS_PER_KEY)))
    if bits > max_bits:
        return df

    def place(key):
        return F.pmod(F.xxhash64(key.cast("string")), F.lit(1 << bits))

    words = (other.filter(okey.isNotNull()).select(place(okey).alias("p"))
             .groupBy(F.shiftright("p", 6).alias(_WORD))
             .agg(F.bit_or(F.expr("shiftleft(1L, CAST(p & 63 AS INT))")).alias(_MASK)))
    key = F.col(f"`{_named(df, on)}`")
    marked = df.withColumn(_PLACE, place(key)).withColumn(_WORD, F.shiftright(_PLACE, 6))
    hit = F.expr(f"shiftright({_MASK}, CAST({_PLACE} & 63 AS INT)) & 1L") == 1
    return (marked.filter(key.isNotNull()).join(F.broadcast(words), _WORD).filter(hit)
            .select(*[F.col(f"`{c}`") for c in df.columns]))


def _present(left: DataFrame, on: str, keys: Sequence) -> list:
    """Those of ``keys`` that ``left`` holds (one aggregate; at most ``len(keys)`` rows)."""
    key = F.col(f"`{_named(left, on)}`")
    return [r[0] for r in left.filter(key.isin(list(keys))).select(key).distinct().collect()]


def join_using(
    left: DataFrame,
    right: DataFrame,
    on: str,
    how: str = "inner",
    left_filter: Expr | None = None,
    right_filter: Expr | None = None,
    broadcast: str | None = None,
    salt_buckets: int = 0,
    max_broadcast_rows: int = BROADCAST_MAX_ROWS,
    max_broadcast_bytes: int = BROADCAST_MAX_BYTES,
    hot: Sequence | str | None = None,
    row_id: Sequence[str] | None = None,
    key_filter: bool = False,
) -> DataFrame:
    """``left JOIN right USING (on)`` with optional per-side filters.

    ``how`` takes any of Spark's spellings. ``cross`` with a key behaves as
    ``inner`` (the key is always given, so the original jobs get the inner
    result); a keyless Cartesian product is not offered.
    ``broadcast`` names the side ("left"/"right") that may be broadcast after
    the size probe. ``salt_buckets`` > 1 handles hot left keys when no side was
    broadcast: their right rows are broadcast after a size check and all other
    rows joined by a plain shuffle (``_split``); where those right rows are too
    many, and in right and full joins, the hot left rows are spread over that
    many tasks (``_salted``). ``hot`` says which keys: None or "auto" finds the
    keys holding at least 1% of the left rows (``hot_keys``), a list names them,
    "all" spreads every key and replicates the whole right side. ``row_id`` names
    the left columns that the salt hashes (``salt_column``). ``key_filter`` drops
    left rows whose key the right side lacks before they are shuffled
    (``reduce_by_keys``; inner, semi and right joins that are not broadcast).
    """
    if not on:
        raise ValueError("a join column is required; keyless Cartesian products are refused")
    kind = normalize_how(how)
    if kind == "cross":
        kind = "inner"
    if isinstance(hot, str) and hot not in ("auto", "all"):
        raise ValueError(f"hot must be a list of key values, 'auto' or 'all', got {hot!r}")
    left = filter_optional(left, left_filter)
    right = filter_optional(right, right_filter)
    check_join_columns(left, right, on, kind)

    broadcasted = False
    if broadcast == "right" and kind in ("inner", "left", "left_semi", "left_anti"):
        right, broadcasted = broadcast_if_bounded(right, max_broadcast_rows, max_broadcast_bytes)
    elif broadcast == "left" and kind in ("inner", "right"):
        left, broadcasted = broadcast_if_bounded(left, max_broadcast_rows, max_broadcast_bytes)
    elif broadcast not in (None, "left", "right"):
        raise ValueError(f"broadcast must be 'left', 'right' or None, got {broadcast!r}")
    if broadcasted:
        return left.join(right, on=on, how=kind)

    if key_filter and kind in ("inner", "left_semi", "right"):
        left = reduce_by_keys(left, right, on)
    if salt_buckets > 1:
        if hot == "all":
            return _salted(left, right, on, kind, salt_buckets, None, row_id)
        keys = hot_keys(left, on) if hot is None or hot == "auto" else _present(left, on, hot)
        if keys and kind not in ("right", "full"):
            split = _split(left, right, on, kind, keys, max_broadcast_rows, max_broadcast_bytes)
            if split is not None:
                return split
        if keys or kind == "full":  # null left keys of a full join spread, too
            return _salted(left, right, on, kind, salt_buckets, keys, row_id)
    return left.join(right, on=on, how=kind)


@dataclass(frozen=True)
class Table:
    """One join-program input with its optional filter."""

    df: DataFrame
    where: Expr | None = None


def join_program(
    tables: Sequence[Table | DataFrame],
    steps: Sequence[JoinStep | str],
    broadcast: Sequence[str | None] | None = None,
    salt_buckets: int = 0,
    hot: str | None = None,
    row_id: Sequence[str] | None = None,
    key_filter: bool = False,
) -> DataFrame:
    """Fold ``steps`` over a list that starts as the filtered ``tables``.

    Each step joins entries ``left`` and ``right`` and appends the result, so
    with n tables the k-th step's output is entry n + k. The program's output
    is the last entry (the last table when there are no steps). The whole
    program is one lazy plan; Catalyst sees every join at once.
    ``salt_buckets``, ``hot`` (None, "auto" or "all"; keys differ per step),
    ``row_id`` and ``key_filter`` apply to every step that is not broadcast, as in
    ``join_using``.
    """
    if hot not in (None, "auto", "all"):
        raise ValueError("hot must be None, 'auto' or 'all' in a join program")
    frames = [
        filter_optional(t.df, t.where) if isinstance(t, Table) else t for t in tables
    ]
    if not frames:
        raise ValueError("a join program needs at least one table")
    plan = [JoinStep.parse(s) if isinstance(s, str) else s for s in steps]
    hints = list(broadcast) if broadcast is not None else [None] * len(plan)
    if len(hints) != len(plan):
        raise ValueError("one broadcast hint (or None) per step")
    for step, hint in zip(plan, hints):
        for idx in (step.left, step.right):
            if not -len(frames) <= idx < len(frames):
                raise IndexError(f"step {step} refers to entry {idx}; only {len(frames)} exist")
        frames.append(
            join_using(frames[step.left], frames[step.right], step.on, step.how, broadcast=hint,
                       salt_buckets=salt_buckets, hot=hot, row_id=row_id, key_filter=key_filter)
        )
    return frames[-1]
