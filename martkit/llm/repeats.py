"""Finding what repeats: the shared distributed steps of the exact joins.

``repeated`` keeps the rows whose 64-bit key occurs with two different
identities; ``hot_keys`` names keys that a noticeable share of all texts holds,
so that they can bypass that exchange; ``bitmap_of`` packs a set of 64-bit
values into a filter of fixed size; ``components`` contracts a graph.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.cache import reliable_checkpoint
from .common import in_arrow, mix64

SAMPLE_TEXTS = 4000   # expected texts in the sample that names hot keys
HOT_SHARE = 0.02      # share of the sampled texts that makes a key hot
TASK_EDGES = 200_000  # edges of a graph that one task contracts
FILTER_BITS = (16, 28)  # least and greatest log2 of the bits of a bitmap filter (32 MB at most)
BITS_PER_KEY = 8        # up to 33 million keys; beyond, more false positives pass


def shuffle_width(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def binary16(data: np.ndarray) -> pa.Array:
    """A (n, 16) byte matrix as an Arrow binary column."""
    n = len(data)
    offsets = np.arange(n + 1, dtype=np.int32) * 16
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets.tobytes()),
                                                  pa.py_buffer(np.ascontiguousarray(data).tobytes())])


def bytes16(column: pa.Array) -> np.ndarray:
    """The inverse of ``binary16``."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), 16)


def repeated(rows: DataFrame, key: str, ident: Sequence[str], *, collapse: bool = False
             ) -> DataFrame:
    """The distinct rows whose ``key`` (a long) occurs with at least two identities.

    One exchange by the key, a spilling sort and a streaming pass that holds
    one row between batches, so no group is ever gathered. With ``collapse``
    the key is replaced by a signature of the group's identities (one column of
    16 bytes), and groups of one batch with the same members are kept once: the
    groups matter then, not the keys behind them.
    """
    columns = [key, *ident]
    dealt = (rows.select(*columns).repartition(shuffle_width(rows), key)
             .sortWithinPartitions(*columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, emitted, multi = None, False, False  # the last row so far and its run's state
        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
            lead = held is not None
            batch = t.to_batches()[0]
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            n = len(keys)
            new_run = np.ones(n, dtype=bool)
            new_run[1:] = keys[1:] != keys[:-1]
            same = ~new_run
            for i in range(1, len(columns)):
                col = batch.column(i)
                if n > 1:
                    same[1:] &= pc.equal(col[1:], col[:-1]).to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(new_run)
            run_of = np.cumsum(new_run) - 1
            differs = ~same & ~new_run
            many = np.bitwise_or.reduceat(differs, starts)
            if lead and multi:
                many[0] = True
            keep = many[run_of] & ~same
            if lead:
                keep[0] = many[0] and not emitted
            last_run = run_of[-1]
            out_keys = keys
            if collapse:
                whole = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint64)
                node = mix64(whole[0::2]) + mix64(whole[1::2] ^ np.uint64(0x9E37))
                signed = np.where(same, np.uint64(0), mix64(node))
                sums = mix64(np.add.reduceat(signed, starts))
                open_run = np.zeros(len(starts), dtype=bool)
                open_run[last_run] = True
                open_run[0] |= lead
                own = mix64(keys.astype(np.uint64)[starts] ^ np.uint64(0xA5A5A5A5))
                sign = np.where(open_run, own, sums)  # a run over two batches keeps its key
                first = np.zeros(len(starts), dtype=bool)
                first[np.unique(sign, return_index=True)[1]] = True
                keep &= (first | open_run)[run_of]
                out_keys = sign[run_of].astype(np.int64)
            emitted, multi = bool(many[last_run]), bool(many[last_run])
            held = batch.slice(n - 1, 1)
            at = np.flatnonzero(keep)
            if len(at):
                took = pa.array(at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out_keys[at], pa.int64()),
                     *(batch.column(i).take(took) for i in range(1, len(columns)))],
                    names=columns)

    return in_arrow(dealt, run, dealt.schema)


def hot_keys(texts: DataFrame, keys: Callable[[DataFrame], DataFrame], total: int, *,
             sample: int = SAMPLE_TEXTS, share: float = HOT_SHARE) -> np.ndarray:
    """Sorted 64-bit keys that at least ``share`` of a sample of the distinct texts hold.

    ``texts`` has ``t``; ``keys`` maps it to rows (h, node), each pair once. The
    sample is chosen by content, about ``sample`` texts; the result is bounded
    by their keys over ``share``. It only steers plans and the order of keys,
    so results do not depend on it.
    """
    part = F.pmod(F.xxhash64("t"), F.lit(1 << 40)) / float(1 << 40)
    some = texts.filter(part < sample / max(total, 1)).select("t")
    rows = reliable_checkpoint(keys(some).distinct())
    counts = rows.groupBy("h").agg(F.count("*").alias("n"))
    n = rows.select("node").distinct().count()
    found = counts.filter(F.col("n") >= max(share * n, 8)).select("h").collect()
    return np.sort(np.array([r["h"] for r in found], dtype=np.int64))


def is_in(sorted_keys: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(sorted_keys):
        return np.zeros(len(values), dtype=bool)
    at = np.minimum(np.searchsorted(sorted_keys, values), len(sorted_keys) - 1)
    return sorted_keys[at] == values


def bits_for(n: int) -> int:
    """log2 of the bits of a filter of ``n`` keys."""
    low, high = FILTER_BITS
    return min(high, max(low, (BITS_PER_KEY * max(n, 1) - 1).bit_length()))


def bitmap_of(values: DataFrame, column: Column) -> bytes:
    """A bitmap of the 64-bit values, sized by their number (``FILTER_BITS``).

    A filter with false positives: who uses it joins exactly afterwards, so the
    size never changes a result.
    """
    bits = bits_for(values.count())
    place = F.pmod(column, F.lit(1 << bits)) + 1  # Spark's buckets count from 1
    maps = (values.select(place.alias("p")).groupBy(F.bitmap_bucket_number("p").alias("b"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("m")).collect())
    whole = np.zeros((1 << bits) // 8, dtype=np.uint8)
    for r in maps:
        lo = (r["b"] - 1) * 4096
        whole[lo:lo + len(r["m"])] |= np.frombuffer(bytes(r["m"]), np.uint8)
    return whole.tobytes()


def in_bitmap(bitmap: bytes, values: np.ndarray) -> np.ndarray:
    bits = np.frombuffer(bitmap, np.uint8)
    p = values.astype(np.int64) & np.int64(len(bits) * 8 - 1)
    return (bits[p >> 3] >> (p & 7).astype(np.uint8) & 1).astype(bool)


def node_long(node: str = "node") -> Column:
    """The first 8 bytes of a 16-byte key as a long, as ``node_longs`` reads them."""
    return F.conv(F.hex(F.substring(node, 1, 7)), 16, 10).cast("long")


def node_longs(nodes: np.ndarray) -> np.ndarray:
    """The first 7 bytes of each 16-byte key, big endian, as non-negative longs."""
    wide = np.zeros((len(nodes), 8), dtype=np.uint8)
    wide[:, 1:] = nodes[:, :7]
    return wide.reshape(-1).view(">u8").astype(np.int64)


def filtered(rows: DataFrame, bitmap: bytes, node: str = "node", flag: str | None = None
             ) -> DataFrame:
    """The rows whose 16-byte key may be in the bitmap; only the keys go through Python.

    With ``flag`` all rows, and the answer as a column of that name.
    """
    shared = rows.sparkSession.sparkContext.broadcast(bitmap)

    @F.arrow_udf(T.BooleanType())
    def may_hold(keys: pa.Array) -> pa.Array:
        return pa.array(in_bitmap(shared.value, node_longs(bytes16(keys))), pa.bool_())

    return rows.withColumn(flag, may_hold(node)) if flag else rows.filter(may_hold(node))


def fetch(texts: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, t) of the texts named by ``nodes``, once each; ``texts`` has node and t."""
    found = filtered(texts.select("node", "t"), bitmap_of(nodes, node_long()))
    return found.join(nodes, "node", "left_semi").groupBy("node").agg(F.first("t").alias("t"))


def grouped(rows: DataFrame, key: str, schema: str | T.StructType,
            work: Callable[[pa.RecordBatch, np.ndarray], Sequence[pa.RecordBatch]], *,
            rows_at_once: int = 4096, dealt: bool = False) -> DataFrame:
    """``work`` over batches that hold the rows of their keys (longs) whole.

    ``work`` gets a batch sorted by the key and the starts of its groups. A
    group must fit into memory: callers split the large ones by their key. ``dealt``
    rows are partitioned and sorted by the key already.
    """
    if not dealt:
        rows = rows.repartition(shuffle_width(rows), key).sortWithinPartitions(key)
    at = rows.columns.index(key)

    def whole(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(parts).combine_chunks()
        for batch in t.to_batches():
            keys = batch.column(at).to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            yield from work(batch, starts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # rows of the last key, which may go on
        for batch in batches:
            for lo in range(0, batch.num_rows, rows_at_once):
                part = batch.slice(lo, rows_at_once)
                keys = part.column(at).to_numpy(zero_copy_only=False)
                if held and held[-1].column(at)[0].as_py() == keys[-1]:
                    held.append(part)
                    continue
                cut = int(np.searchsorted(keys, keys[-1], side="left"))
                ready = [*held, part.slice(0, cut)]
                held = [part.slice(cut)]
                if sum(b.num_rows for b in ready):
                    yield from whole(ready)
        if held:
            yield from whole(held)

    return in_arrow(rows, run, schema)


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(u, v) from each node of a task's edges to the smallest node it reaches by them."""
    above: dict = {}

    def root(x):
        top = x
        while above[top] != top:
            top = above[top]
        while above[x] != top:
            above[x], x = top, above[x]
        return top

    schema = None
    for batch in batches:
        schema = batch.schema
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            above.setdefault(u, u)
            above.setdefault(v, v)
            a, b = root(u), root(v)
            if a != b:
                above[max(a, b)] = min(a, b)
    if schema is not None:
        ends = [(x, root(x)) for x in above]
        ends = [(x, top) for x, top in ends if x != top]
        yield pa.RecordBatch.from_arrays(
            [pa.array([e[k] for e in ends], schema.field(k).type) for k in (0, 1)],
            names=["u", "v"])


def components(edges: DataFrame, *, per_task: int = TASK_EDGES) -> DataFrame:
    """(node, comp): the smallest node reachable over ``edges`` (a, b).

    The edges are dealt to tasks of about ``per_task``; each contracts its own to
    stars. Where that took several tasks, the stars are contracted by alternating
    large-star and small-star rounds: each is two pre-aggregated minima and joins
    over the edges, written to the checkpoint folder, and the rounds grow with the
    logarithm of the longest path.
    """
    e = (edges.filter("a <> b").select(F.greatest("a", "b").alias("u"),
                                       F.least("a", "b").alias("v")).distinct())
    e = reliable_checkpoint(e)
    tasks = -(-e.count() // per_task) or 1
    dealt = e.coalesce(1) if tasks == 1 else e.repartition(tasks, "u", "v")
    e = reliable_checkpoint(in_arrow(dealt, _stars, e.schema))
    mark = None
    while tasks > 1:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .filter("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = (joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
        e = reliable_checkpoint(small)
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == mark:
            break
        mark = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("comp")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())
