"""The prefix trie of conversations, with subtree totals by time-forward processing.

Nodes are the distinct sequences of first turns. A sequence is known by its
depth and the exclusive or of 128-bit hashes of its (place, role, text), which
running windows over chunks of a conversation give without gathering it.

Subtree totals go from children to parents. Nodes are dealt to shards by range
of (smallest member, depth); a parent never comes later in that order than its
children, so a path from a node to the root leaves a shard once and never comes
back. Within a shard nodes are sorted by reverse level order and each sends its
total to its parent through a priority queue that spills sorted runs. What is
addressed to another shard is summed per receiver; the receivers form a smaller
trie of their own ("across shard roots"), which is solved in the same way, and a
second pass adds what they hand down. Shards are sized by rows, whatever one
conversation or one node holds, so no task gets an unbounded group.
"""

from __future__ import annotations

import hashlib
import heapq
import os
import pickle
import tempfile
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.cache import reliable_checkpoint
from .common import table
from .repeats import shuffle_width

HEAD_TURNS = 8        # turns of the leading conversation that a rebuilt one can take (h is 0 to 8)
GROUP = 5             # conversations that share a leading one
CHUNK = 1024          # turns of a conversation hashed in one window
SHARD_ROWS = 200_000  # nodes of a shard, about
QUEUE_ROWS = 100_000  # messages a queue holds before it spills
PIECE = 1 << 20       # bytes of conversation ids handed on at once


# --- rebuilt conversations -----------------------------------------------------

def numbered(conversations: DataFrame) -> DataFrame:
    """(conv_id, idx, t1, t2, bytes): turns in order (null first; ties by role, then text), from 0.

    ``t1`` and ``t2`` are 120 bits of the hash of (role, text), ``bytes`` the text's
    size: the texts move once. Rows without conv_id are left out. The rows are
    dealt by range of the whole order, so a conversation with very many turns is
    spread over tasks; a turn's place is its place in its part plus the turns in the
    parts before. At most one conversation of a part began in an earlier one, so
    what is added is a row a part.
    """
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"),
                                F.col("turn").alias("turn"), role.alias("role"), text.alias("text"))
    whole = F.md5(F.concat_ws("\x00", F.octet_length("role").cast("string"), "role", "text")
                  .cast("binary"))
    part = lambda k: F.conv(F.substring(whole, 1 + 15 * k, 15), 16, 10).cast("long")
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    dealt = (rows.filter("conv_id is not null")
             .withColumns({"t1": part(0), "t2": part(1),
                           "bytes": F.octet_length("text").cast("long")})
             .repartitionByRange(shuffle_width(rows), F.col("conv_id"), *order)
             .sortWithinPartitions("conv_id", *order)
             .select("conv_id", F.spark_partition_id().alias("part"), "t1", "t2", "bytes"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, seen = None, 0  # the last conversation, and its turns so far
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            if not len(ids):
                continue
            at = np.arange(len(ids))
            new = np.ones(len(ids), dtype=bool)
            new[1:] = ids[1:] != ids[:-1]
            idx = at - np.maximum.accumulate(np.where(new, at, 0))
            if ids[0] == conv:
                idx[ids == conv] += seen
            conv, seen = int(ids[-1]), int(idx[-1]) + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(idx, pa.int64())],
                                             names=[*batch.schema.names, "idx"])

    dealt = reliable_checkpoint(dealt.mapInArrow(
        count, "conv_id long, part int, t1 long, t2 long, bytes long, idx long"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1)
    parts = (dealt.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
             .withColumn("before", F.sum("n").over(before))
             .filter("before > 0").select("conv_id", "part", "before"))
    return (dealt.join(F.broadcast(parts), ["conv_id", "part"], "left")
            .select("conv_id", (F.col("idx") + F.coalesce("before", F.lit(0))).alias("idx"),
                    "t1", "t2", "bytes"))


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations as the contract of the query rebuilds them, from numbered turns.

    Returns (conv_id, n): every conversation and its turns, and (conv_id, pos, t1,
    t2, bytes): those turns, from 0. Conversation c starts with the first
    h = crc32(c) mod 9 turns of c - c mod 5 (SQL's mod: the sign of c) and goes on
    with its own turns after its first h.
    """
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("own"))
    head = F.col("conv_id") - F.col("conv_id") % GROUP
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (HEAD_TURNS + 1))
    convs = sizes.select("conv_id", "own", head.alias("lead"), h.alias("h"))
    lead = sizes.filter(F.col("conv_id") % GROUP == 0).select(
        F.col("conv_id").alias("lead"), F.col("own").alias("led"))
    taken = F.least("h", F.coalesce("led", F.lit(0)))
    convs = reliable_checkpoint(convs.join(lead, "lead", "left").select(
        "conv_id", "lead", "h", taken.alias("taken"),
        (taken + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("n")))
    leading = turns.filter((F.col("conv_id") % GROUP == 0) & (F.col("idx") < HEAD_TURNS)).select(
        F.col("conv_id").alias("lead"), F.col("idx").alias("pos"), "t1", "t2", "bytes")
    heads = (convs.join(leading, "lead").filter("pos < taken")
             .select("conv_id", "pos", "t1", "t2", "bytes"))
    shift = convs.select("conv_id", "h", (F.col("taken") - F.col("h")).alias("by"))
    tails = (turns.join(shift, "conv_id").filter("idx >= h")
             .select("conv_id", (F.col("idx") + F.col("by")).alias("pos"), "t1", "t2", "bytes"))
    return convs.select("conv_id", "n"), heads.unionByName(tails)


# --- nodes -----------------------------------------------------------------------

def prefixes(turns: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(conv_id, depth, x1, x2, p1, p2, bytes): the node of each turn, and its parent's key."""
    rows = turns.select("conv_id", "pos", (F.col("pos") / chunk).cast("long").alias("chunk"),
                        "bytes", F.xxhash64("pos", "t1", "t2").alias("t1"),
                        F.xxhash64("t2", "pos", "t1").alias("t2"))
    so_far = Window.partitionBy("conv_id", "chunk").orderBy("pos").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumns({f"x{k}": F.bit_xor(f"t{k}").over(so_far) for k in (1, 2)})
    later = rows.select("conv_id", "chunk", "t1", "t2")
    whole = later.groupBy("conv_id", "chunk").agg(F.bit_xor("t1").alias("c1"),
                                                  F.bit_xor("t2").alias("c2"))
    before = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(
        Window.unboundedPreceding, -1)
    whole = (whole.withColumns({f"c{k}": F.bit_xor(f"c{k}").over(before) for k in (1, 2)})
             .filter("chunk > 0"))
    rows = rows.join(whole, ["conv_id", "chunk"], "left")
    for k in (1, 2):
        rows = rows.withColumn(f"x{k}", F.col(f"x{k}").bitwiseXOR(F.coalesce(f"c{k}", F.lit(0))))
    return rows.select("conv_id", (F.col("pos") + 1).alias("depth"), "x1", "x2",
                       *[F.col(f"x{k}").bitwiseXOR(F.col(f"t{k}")).alias(f"p{k}") for k in (1, 2)],
                       "bytes")


def trie_nodes(convs: DataFrame, turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes without totals, and (conv_id, depth, member): each conversation's last node.

    Nodes: conv_id, depth, parent_conv_id, n_convs, ends, bytes. Hot nodes are
    counted before the exchange; a node with very many children is a hot key of
    an equi-join, whose larger side Spark splits.
    """
    rows = reliable_checkpoint(prefixes(turns).join(convs, "conv_id"))
    nodes = reliable_checkpoint(rows.groupBy("depth", "x1", "x2").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"),
        F.sum((F.col("n") == F.col("depth")).cast("long")).alias("ends"),
        F.max("bytes").alias("bytes"), F.min("p1").alias("p1"), F.min("p2").alias("p2")))
    root = reliable_checkpoint(convs.agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"),
        F.sum((F.col("n") == 0).cast("long")).alias("ends")).filter("n_convs > 0"))
    first = F.col("depth") == 1
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("x1").alias("p1"),
                           F.col("x2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    shown = ["conv_id", "depth", "parent_conv_id", "n_convs", "ends", "bytes"]
    top = root.select("conv_id", F.lit(0).cast("long").alias("depth"),
                      F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", "ends",
                      F.lit(0).cast("long").alias("bytes"))
    # the root's children are not joined by key: the root is a single row
    below = nodes.filter(first).join(
        F.broadcast(root.select(F.col("conv_id").alias("parent_conv_id"))))
    deeper = nodes.filter(~first).join(parents, ["depth", "p1", "p2"])
    whole = top.unionByName(below.select(*shown)).unionByName(deeper.select(*shown))
    last = rows.filter(F.col("n") == F.col("depth")).select(
        F.col("conv_id").alias("member"), "depth", "x1", "x2")
    ends = last.join(nodes.select("conv_id", "depth", "x1", "x2"), ["depth", "x1", "x2"]).select(
        "conv_id", "depth", "member")
    none = convs.filter("n = 0").select(F.col("conv_id").alias("member")).join(
        F.broadcast(top.select("conv_id", "depth")))
    return whole, ends.unionByName(none.select("conv_id", "depth", "member"))


def end_digests(ends: DataFrame) -> DataFrame:
    """(conv_id, depth, ends_sha256) of the nodes at which conversations end.

    The members are sorted by range and written out as pieces of text, which a
    streaming pass feeds to the digest in order: a node's members are never held
    together.
    """
    dealt = ends.repartitionByRange(shuffle_width(ends), "conv_id", "depth", "member")
    dealt = dealt.sortWithinPartitions("conv_id", "depth", "member")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = []
            for conv, depth, member in zip(*(c.to_pylist() for c in batch.columns)):
                if not out or out[-1][:2] != [conv, depth] or len(out[-1][3]) > PIECE:
                    out.append([conv, depth, member, b""])
                out[-1][3] += (b"," if out[-1][3] else b"") + str(member).encode()
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[k] for o in out], kind) for k, kind in enumerate(
                    (pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
                names=["conv_id", "depth", "member", "ids"])

    parts = dealt.mapInArrow(pieces, "conv_id long, depth long, member long, ids binary")
    parts = parts.repartition(shuffle_width(ends), "conv_id", "depth").sortWithinPartitions(
        "conv_id", "depth", "member")

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, hashlib.sha256()
        for batch in batches:
            out = []
            for conv, depth, ids in zip(*(batch.column(c).to_pylist() for c in (0, 1, 3))):
                if node == (conv, depth):
                    state.update(b",")
                else:
                    if node:
                        out.append((*node, state.hexdigest()))
                    node, state = (conv, depth), hashlib.sha256()
                state.update(ids)
            yield _batch(out, (pa.int64(), pa.int64(), pa.string()), names)
        if node:
            yield _batch([(*node, state.hexdigest())], (pa.int64(), pa.int64(), pa.string()), names)

    names = ["conv_id", "depth", "ends_sha256"]
    return parts.mapInArrow(digests, "conv_id long, depth long, ends_sha256 string")


def _batch(rows: list[tuple], kinds, names) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=list(names))


# --- time-forward processing ---------------------------------------------------------

class SpillingQueue:
    """A priority queue of messages (key..., values...) that spills sorted runs.

    Spilled runs are unnamed files in the folders that Spark gives the executor for
    its own spills; they vanish with the task.
    """

    def __init__(self, limit: int = QUEUE_ROWS):
        self.limit, self.heap, self.runs, self.spills = limit, [], [], 0

    def push(self, message: tuple) -> None:
        heapq.heappush(self.heap, message)
        if len(self.heap) > self.limit:
            self._spill()

    def _spill(self) -> None:
        folder = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None
        file = tempfile.TemporaryFile(dir=folder if folder and os.path.isdir(folder) else None)
        run = sorted(self.heap)
        for i in range(0, len(run), 1024):
            pickle.dump(run[i:i + 1024], file)
        file.seek(0)
        self.heap = []
        self.spills += 1
        self._head(self.spills, self._read(file))

    @staticmethod
    def _read(file) -> Iterator[tuple]:
        with file:
            while True:
                try:
                    yield from pickle.load(file)
                except EOFError:
                    return

    def _head(self, number: int, run: Iterator[tuple]) -> None:
        message = next(run, None)
        if message is not None:
            heapq.heappush(self.runs, (message, number, run))

    def take(self, key: tuple) -> Iterator[tuple]:
        """The messages of the key, which is the least that is left."""
        n = len(key)
        while self.heap and self.heap[0][:n] == key:
            yield heapq.heappop(self.heap)
        while self.runs and self.runs[0][0][:n] == key:
            message, number, run = heapq.heappop(self.runs)
            yield message
            self._head(number, run)


def _reverse_levels(rows: Iterator[tuple], limit: int) -> Iterator[tuple]:
    """(row, children, leaves, saved): totals inside the shard, and what receivers hand down.

    ``rows`` are (conv, depth, pconv, pdepth, leaves, saved, inside, down), the
    deepest first; ``inside`` says whether the parent is in the shard, ``down`` has
    the totals that reach the node from other shards (leaves, saved), or None.
    """
    queue = SpillingQueue(limit)
    for row in rows:
        conv, depth, pconv, pdepth, leaves, saved, inside, down = row
        kids = from_leaves = from_saved = 0
        for m in queue.take((-depth, conv)):
            kids += 1
            leaves += m[2]
            saved += m[3]
            from_leaves += m[4]
            from_saved += m[5]
        if down is not None:
            from_leaves, from_saved = down
        if inside:
            queue.push((-pdepth, pconv, leaves, saved, from_leaves, from_saved))
        yield row, kids, leaves + from_leaves, saved + from_saved


def _sharded(t: DataFrame, shards: int) -> DataFrame:
    """``t`` with ``shard`` and ``pshard`` (its parent's), written to the checkpoint folder.

    The bounds of the shards reach the driver: one row for each task, as Spark's
    own task list does.
    """
    if shards == 1:
        return reliable_checkpoint(t.coalesce(1).withColumns(
            {"shard": F.lit(0), "pshard": F.when(F.col("pconv").isNotNull(), 0)}))
    dealt = reliable_checkpoint(t.repartitionByRange(shards, "conv", "depth")
                                .withColumn("shard", F.spark_partition_id()))
    lows = dealt.groupBy("shard").agg(F.min(F.struct("conv", "depth")).alias("low")).collect()
    bounds = sorted(((r["low"]["conv"], r["low"]["depth"]), r["shard"]) for r in lows)
    keys, numbers = [b[0] for b in bounds], [b[1] for b in bounds]

    @F.arrow_udf("int")
    def shard_of(conv: pa.Array, depth: pa.Array) -> pa.Array:
        return pa.array([None if c is None else numbers[bisect_right(keys, (c, d)) - 1]
                         for c, d in zip(conv.to_pylist(), depth.to_pylist())], pa.int32())

    return dealt.withColumn("pshard", shard_of("pconv", "pdepth"))


def subtree_totals(nodes: DataFrame, *, shard_rows: int = SHARD_ROWS,
                   queue_rows: int = QUEUE_ROWS, most: int | None = None) -> DataFrame:
    """(conv, depth, children, leaves, saved): sums over each node's subtree.

    ``nodes`` has conv, depth (the key), pconv, pdepth (the parent's key, null for
    the root; pconv <= conv, pdepth < depth), leaves and saved (the node's own).
    """
    nodes = reliable_checkpoint(nodes)
    rows = nodes.count()
    shards = max(1, -(-rows // shard_rows))
    shards = min(shards, most or shards)
    dealt = _sharded(nodes, shards)
    order = [F.col("depth").desc(), F.col("conv")]
    kinds = (pa.int64(),) * 5

    def column(batch: pa.RecordBatch, name: str) -> list:
        return batch.column(name).to_pylist()

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for b in batches:
            inside = [x is not None and x == y for x, y in zip(column(b, "pshard"), column(b, "shard"))]
            down = ([None if x is None else (x, y) for x, y in zip(
                column(b, "down_leaves"), column(b, "down_saved"))]
                if "down_leaves" in b.schema.names else [None] * b.num_rows)
            yield from zip(*(column(b, c) for c in (
                "conv", "depth", "pconv", "pdepth", "leaves", "saved")), inside, down)

    def messages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What leaves the shard, to (conv, depth): children, leaves, saved; summed."""
        out: dict[tuple, list[int]] = {}
        for row, _, leaves, saved in _reverse_levels(rows_of(batches), queue_rows):
            if row[2] is not None and not row[6]:
                sums = out.setdefault((row[2], row[3]), [0, 0, 0])
                for k, v in enumerate((1, leaves, saved)):
                    sums[k] += v
                if len(out) >= queue_rows:
                    yield _batch([(*k, *v) for k, v in out.items()], kinds, sent)
                    out = {}
        yield _batch([(*k, *v) for k, v in out.items()], kinds, sent)

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for row, kids, leaves, saved in _reverse_levels(rows_of(batches), queue_rows):
            out.append((row[0], row[1], kids, leaves, saved))
            if len(out) >= 8192:
                yield _batch(out, kinds, sent)
                out = []
        yield _batch(out, kinds, sent)

    sent = ("conv", "depth", "children", "leaves", "saved")
    schema = "conv long, depth long, children long, leaves long, saved long"

    def in_shards(df: DataFrame, *by: Column) -> DataFrame:
        if shards == 1:
            return df.coalesce(1).sortWithinPartitions(*by)
        return df.repartition(shards, "shard").sortWithinPartitions(*by)

    if shards == 1:
        return in_shards(dealt, *order).mapInArrow(totals, schema)

    incoming = reliable_checkpoint(
        in_shards(dealt, *order).mapInArrow(messages, schema).groupBy("conv", "depth").agg(
            *[F.sum(c).alias(c) for c in ("children", "leaves", "saved")]))
    marked = dealt.join(incoming.select("conv", "depth", F.lit(True).alias("receives")),
                        ["conv", "depth"], "left")

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each receiver's parent in the trie of receivers: the nearest one above it."""
        near: dict[tuple, tuple] = {}  # at or above each node of the shard
        for b in batches:
            out = []
            for conv, depth, pconv, pdepth, shard, pshard, receives in zip(*(column(b, c) for c in (
                    "conv", "depth", "pconv", "pdepth", "shard", "pshard", "receives"))):
                above = (pconv, pdepth)
                if pshard is not None and pshard == shard:
                    above = near[above]
                near[conv, depth] = (conv, depth) if receives else above
                if receives:
                    out.append((conv, depth, *above))
            yield _batch(out, kinds[:4], ("conv", "depth", "pconv", "pdepth"))

    linked = in_shards(marked, F.col("depth"), F.col("conv")).mapInArrow(
        links, "conv long, depth long, pconv long, pdepth long")
    upper = reliable_checkpoint(linked.join(incoming.drop("children"), ["conv", "depth"]))
    # the next level has fewer nodes; should it not, it gets fewer shards
    fewer = shards // 2 if upper.count() >= rows else None
    down = subtree_totals(upper, shard_rows=shard_rows, queue_rows=queue_rows, most=fewer)
    handed = reliable_checkpoint(down.select("conv", "depth", F.col("leaves").alias("down_leaves"),
                                             F.col("saved").alias("down_saved")))
    whole = in_shards(dealt.join(handed, ["conv", "depth"], "left"), *order).mapInArrow(
        totals, schema)
    more = incoming.select("conv", "depth", F.col("children").alias("more"))
    return whole.join(more, ["conv", "depth"], "left").select(
        "conv", "depth", (F.col("children") + F.coalesce("more", F.lit(0))).alias("children"),
        "leaves", "saved")


def prefix_trie(convs: DataFrame, turns: DataFrame, *, shard_rows: int = SHARD_ROWS,
                queue_rows: int = QUEUE_ROWS) -> DataFrame:
    """One row per node of the trie of ``turns`` (conv_id, pos from 0, t1, t2, bytes).

    ``convs`` has every conversation (conv_id, unique) and its number of turns n.
    Returns conv_id (the smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens and ends_sha256. Without conversations
    there are no nodes, the root included; with turnless ones only, the root.
    """
    nodes, ends = trie_nodes(convs, turns)
    nodes = reliable_checkpoint(nodes)
    own = nodes.select(
        F.col("conv_id").alias("conv"), "depth", F.col("parent_conv_id").alias("pconv"),
        F.when(F.col("parent_conv_id").isNotNull(), F.col("depth") - 1).alias("pdepth"),
        (F.col("ends") == F.col("n_convs")).cast("long").alias("leaves"),  # nobody goes on
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"))
    sums = subtree_totals(own, shard_rows=shard_rows, queue_rows=queue_rows).select(
        F.col("conv").alias("conv_id"), "depth", F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))
    key = ["conv_id", "depth"]
    out = nodes.join(sums, key).join(end_digests(ends), key, "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                      "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256))
                      .alias("ends_sha256"))


def op11_prefix_trie(spark, sf_dir: str) -> DataFrame:
    """The trie of all rebuilt conversations."""
    convs, turns = rebuilt(numbered(table(spark, sf_dir, "conversations")))
    return prefix_trie(convs, turns)
