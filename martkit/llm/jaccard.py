"""N-gram Jaccard join over count vectors.

A text's set holds its distinct shingles of five words. The shingles are hashed
into groups; the group counts are a point, and the overlap of two sets is at
most the sum over the groups of the smaller count. Points are kept in R-trees:
a box bounds the overlap with every point below it by the sum of the smaller of
the query's coordinate and the box's upper coordinate.

The trees are distributed by cells. In one global order of the shingles two
linked sets share one of their first n - ceil(0.8 n) + 1 shingles (of the smaller
set, of its first n - ceil(0.89 n) + 1), so the sets
that hold a shingle there form a cell, and linked sets meet in a cell. Any
order is right; rare shingles come first here, by the frequencies of their
words in a bounded sample, so that unrelated sets seldom share a cell. Cells
with the same members are one cell. Equal sets are one point.

Links are wanted as components, so a cell needs no more work once all its
points are connected. First, in rounds, every point proposes one neighbour
that the tree lets through (in very wide cells: one pivot of the cell); that is
linear, and copies and near copies are connected then, most of them in the first
round, which takes a few cells of each point only. In cells that still hold
several components the tree is searched for all pairs of different components,
each pair in the first cell it shares, and verified on the full sets where it is
found; only edges that connect components leave a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.cache import reliable_checkpoint
from .common import (add_columns, in_arrow, lower_bytes, mix64, no_rows, others, prefix_hash, quoted,
                     raw_bytes, release, span_hash, table, text_key, text_of, text_slices, window_hash, word_spans)
from .repeats import (SAMPLE_TEXTS, binary16, components, fetch, grouped, hot_keys, is_in,
                      shuffle_width)

SHINGLE = 5
PERCENT = 80          # linked: 100 * intersection >= PERCENT * union
FEWEST_GROUPS = 16    # coordinates of a point of a small set
LEAF = 32             # points of a leaf box
BLOCK = 512           # points of a cell that one task searches against another block
WIDE = 4096           # points of a cell above which proposals go to one pivot of the cell
FEW_CELLS = 4         # cells of a point in the first round of proposals, and in each of pivots
PROPOSALS = 2         # rounds in which every point proposes a neighbour
MAX_ROUNDS = 8        # rounds of pivots, while wide cells shrink, before all pairs are searched
COMMON_WORDS = 1 << 16  # words whose sampled frequency orders the shingles


@dataclass(frozen=True)
class Order:
    """The global order of shingles: by level, then hash; the hot ones last.

    A shingle's level is the rounded sum of the log frequencies of its words (the
    fixed quantum of the order); a word outside the table counts as rarer than
    any inside.
    """

    words: np.ndarray   # sorted hashes (uint64) of common words
    levels: np.ndarray  # log2 of their frequency over that of a rare word
    hot: np.ndarray     # sorted hot shingles

    def of_words(self, words: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.zeros(len(words), dtype=np.float32)
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        return np.where(self.words[at] == words, self.levels[at], np.float32(0))

    def prefix(self, shingles: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, int]:
        """The first n - ceil(percent n / 100) + 1 of a sorted set: (ordinary, hot, short).

        ``short`` of them, n - ceil(2 percent n / (100 + percent)) + 1, are enough for
        the smaller one of two linked sets.
        """
        n = len(shingles)
        length = n - -(-percent * n // 100) + 1 if n else 0
        short = n - -(-2 * percent * n // (100 + percent)) + 1 if n else 0
        last = is_in(self.hot, shingles)
        ordinary = shingles[~last][:length]
        return ordinary, shingles[last][:length - len(ordinary)], short


NO_ORDER = Order(np.zeros(0, np.uint64), np.zeros(0, np.float32), np.zeros(0, np.int64))


def batch_words(texts: pa.Array) -> Iterator[tuple[np.ndarray, list[int]]]:
    """Word hashes of slices of a batch, and the first word of each text (one more at the end)."""
    data, offsets = raw_bytes(texts)
    for lo, hi in text_slices(offsets):
        part = lower_bytes(data[offsets[lo]:offsets[hi]])
        local = offsets[lo:hi + 1] - offsets[lo]
        starts, ends = word_spans(part, local)
        yield (span_hash(prefix_hash(part), starts, ends),
               np.searchsorted(starts, local).tolist())


def shingle_sets(texts: pa.Array, size: int = SHINGLE, order: Order = NO_ORDER
                 ) -> Iterator[np.ndarray]:
    """The distinct shingles (int64) of each text in the global order.

    A shingle is its level in the top byte and 56 bits of the hash of its
    words, so the values sort in the global order. A text of fewer words has
    its whole sequence as one shingle.
    """
    for words, first in batch_words(texts):
        grams = (window_hash(words, size) >> np.uint64(8)).astype(np.int64)
        if len(order.words):
            total = np.concatenate([[0], np.cumsum(order.of_words(words), dtype=np.float64)])
            grams |= np.rint(total[size:] - total[:-size]).astype(np.int64).clip(0, 127) << 56
        for a, b in zip(first[:-1], first[1:]):
            if b - a >= size:
                s = np.sort(grams[a:b - size + 1])
                new = np.ones(len(s), dtype=bool)
                np.not_equal(s[1:], s[:-1], out=new[1:])
                yield s[new]
            elif b > a:
                yield ((window_hash(words[a:b], b - a) >> np.uint64(8)).astype(np.int64)
                       ^ np.int64(b - a))
            else:
                yield np.zeros(0, dtype=np.int64)


def node_of(shingles: np.ndarray) -> bytes:
    """16-byte key of a set; empty for the empty set."""
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else b""


def groups_of(n: int) -> int:
    """Coordinates of a set of n: a power of two, between n / 8 and n / 4 for larger sets.

    Two unrelated sets then differ by about 0.4 n, twice what linked sets may.
    """
    return max(FEWEST_GROUPS, 1 << max(0, n.bit_length() - 3))


def point_of(shingles: np.ndarray) -> bytes:
    """The set's size and the counts of its shingles by group, packed; linked sets are near."""
    groups = groups_of(len(shingles))
    h = shingles.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)
    counts = np.bincount((h & np.uint64(groups - 1)).astype(np.int64), minlength=groups)
    return (np.array([len(shingles)], "<u4").tobytes()
            + np.minimum(counts, _FULL).astype(np.uint8).tobytes())


_FULL = 255  # a coordinate that is full may be any larger count; the mean is 4 to 8


def unpacked(points: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(sizes, counts) of packed points, folded to the fewest coordinates among them.

    Groups are nested, so counts at half the resolution are sums of two. Full
    coordinates bound nothing.
    """
    if not len(points):
        return np.zeros(0, np.int64), np.zeros((0, FEWEST_GROUPS), np.int32)
    widths = np.array([len(p) for p in points])
    groups = widths.min() - 4
    sizes, counts = np.zeros(len(points), np.int64), np.zeros((len(points), groups), np.int32)
    for w in np.unique(widths).tolist():
        at = np.flatnonzero(widths == w)
        rows = np.frombuffer(b"".join(points[i] for i in at.tolist()), np.uint8).reshape(len(at), w)
        sizes[at] = np.ascontiguousarray(rows[:, :4]).view("<u4")[:, 0]
        wide = rows[:, 4:].astype(np.int64)
        wide[wide == _FULL] = 1 << 30
        counts[at] = np.minimum(wide.reshape(len(at), -1, groups).sum(1), 1 << 30)
    return sizes, counts


def overlap_bound(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sum over the coordinates of the smaller count."""
    return np.minimum(a, b).sum(1, dtype=np.int64)


def needed(n_a, n_b, percent: int = PERCENT):
    """Least overlap of two linked sets of these sizes: 100 i >= percent (a + b - i)."""
    return -(-percent * (n_a + n_b) // (100 + percent))


class CountTree:
    """R-tree over count vectors of one resolution, packed by size, then by the first coordinates."""

    def __init__(self, sizes: np.ndarray, points: np.ndarray, leaf: int = LEAF) -> None:
        self.order = np.lexsort((points[:, 1], points[:, 0], sizes))
        self.points, self.sizes = points[self.order], sizes[self.order]
        self.levels = []  # from the leaves up: (upper corner, least size, greatest size)
        upper, least, most = self.points, self.sizes, self.sizes
        while len(upper) > 1:
            cuts = np.arange(0, len(upper), leaf)
            upper = np.maximum.reduceat(upper, cuts, axis=0)
            least, most = np.minimum.reduceat(least, cuts), np.maximum.reduceat(most, cuts)
            self.levels.append((upper, least, most))
        self.leaf = leaf

    def search(self, sizes: np.ndarray, queries: np.ndarray, percent: int = PERCENT
               ) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, point) whose overlap bound allows a link, by numbers.

        All queries go down the tree together, a level at a time.
        """
        low, high = -(-percent * sizes // 100), 100 * sizes // percent
        q = at = None
        top = (self.points, self.sizes, self.sizes)
        for upper, least, most in [*reversed(self.levels), top]:
            if q is None:
                q = np.repeat(np.arange(len(queries)), len(upper))
                at = np.tile(np.arange(len(upper)), len(queries))
            else:
                q = np.repeat(q, self.leaf)
                at = (at[:, None] * self.leaf + np.arange(self.leaf)).ravel()
                q, at = q[at < len(upper)], at[at < len(upper)]
            fits = (least[at] <= high[q]) & (most[at] >= low[q])
            q, at = q[fits], at[fits]
            ok = np.zeros(len(q), dtype=bool)
            for lo in range(0, len(q), 4096):  # bounded memory
                i, j = q[lo:lo + 4096], at[lo:lo + 4096]
                bound = overlap_bound(upper[j], queries[i])
                ok[lo:lo + 4096] = bound >= needed(sizes[i], np.maximum(least[j], low[i]),
                                                        percent)
            q, at = q[ok], at[ok]
        return q, self.order[at]


def _memberships(texts: DataFrame, order: Order, percent: int, size: int) -> DataFrame:
    """(h, rank, a, b, hot): each distinct set of a task with the shingles of its prefix.

    ``rank`` is twice the set's size, and one more for shingles behind the short prefix.
    ``a`` and ``b`` are the halves of the set's key.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            hs, ranks, nodes, counts, flags = [], [], [], [], []

            def flush():
                keys = np.repeat(np.frombuffer(b"".join(nodes), np.int64).reshape(-1, 2),
                                 np.array(counts), axis=0)
                return pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(hs), pa.int64()),
                     pa.array(np.concatenate(ranks), pa.int64()),
                     pa.array(np.ascontiguousarray(keys[:, 0])),
                     pa.array(np.ascontiguousarray(keys[:, 1])),
                     pa.array(np.concatenate(flags))],
                    names=["h", "rank", "a", "b", "hot"])

            held = 0
            for s in shingle_sets(batch.column(0), size, order):
                node = node_of(s)
                if not node or node in seen:
                    continue
                seen.add(node)
                a, b, short = order.prefix(s, percent)
                hs += [a, b]
                n = len(a) + len(b)
                ranks.append(2 * len(s) + (np.arange(n) >= short))
                flags += [np.zeros(len(a), bool), np.ones(len(b), bool)]
                nodes.append(node)
                counts.append(n)
                held += n
                if held >= 200_000:
                    yield flush()
                    hs, ranks, nodes, counts, flags, held = [], [], [], [], [], 0
            if held:
                yield flush()

    return in_arrow(texts.select("t"), run, "h long, rank long, a long, b long, hot boolean")


def _cells(rows: DataFrame, percent: int) -> DataFrame:
    """(h, node): the memberships that may hold a link, cells of equal members once.

    Linked sets share a shingle that is in the short prefix of the smaller one, so a
    member stays if a member of its size or less, down to ``percent`` of it, holds
    the shingle in its short prefix, or if it does itself and a member of its size
    or more is near. Sorted by size, short prefixes first, the nearest ones are
    the row before and the row after, so one streaming pass with one row between
    batches tells; no cell is gathered. A cell that lies in one batch gets a
    signature of its members as its key and is kept once. Hot shingles are spread by
    their members and pass as they are, in the same exchange.
    """
    columns = ["h", "rank", "a", "b"]
    deal = F.when(F.col("hot"), F.xxhash64("h", "a")).otherwise(F.col("h"))
    dealt = (rows.select(*columns, "hot").repartition(shuffle_width(rows), deal)
             .sortWithinPartitions(*columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passed: list[pa.RecordBatch] = []   # rows of hot shingles

        def ordinary() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hot = batch.column("hot")
                if pc.any(hot).as_py():
                    part = batch.filter(hot)
                    a, b = (part.column(c).to_numpy(zero_copy_only=False) for c in ("a", "b"))
                    passed.append(pa.RecordBatch.from_arrays(
                        [part.column("h"), binary16(np.column_stack([a, b]).view(np.uint8))],
                        names=["h", "node"]))
                    batch = batch.filter(pc.invert(hot))
                yield batch.select(columns)

        rest: pa.RecordBatch | None = None  # the last row, whose next one is not known yet
        behind = (0, -1)                    # key and size of the last short prefix before it
        for batch, last in _with_last(ordinary()):
            yield from passed
            passed.clear()
            if rest is not None:
                batch = pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
            h, rank, a, b = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            fresh = np.ones(len(h), dtype=bool)  # a set may come from several tasks
            fresh[1:] = (h[1:] != h[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])
            if not fresh.all():
                batch = batch.filter(pa.array(fresh))
                h, rank, a, b = h[fresh], rank[fresh], a[fresh], b[fresh]
            n, short = rank >> 1, rank & 1 == 0
            at = np.arange(len(h))
            near = np.maximum.accumulate(np.where(short, at, -1))
            before = np.concatenate([[-1], near[:-1]])  # the short prefix before each row
            known = before >= 0
            least = np.where(known & (h[before] == h), n[before],
                             np.where(~known & (h == behind[0]), behind[1], -1))
            ok = 100 * least >= percent * n
            follows = np.zeros(len(h), dtype=bool)
            follows[:-1] = (h[1:] == h[:-1]) & (percent * n[1:] <= 100 * n[:-1])
            ok |= short & follows
            end = len(h) if last else len(h) - 1  # without the row that comes again
            if not last:
                rest = batch.slice(end, 1)
            if end and near[end - 1] >= 0:
                behind = (int(h[near[end - 1]]), int(n[near[end - 1]]))
            starts = np.flatnonzero(np.concatenate([[True], h[1:end] != h[:end - 1]])[:end])
            if not len(starts):
                continue
            run_of = np.cumsum(np.concatenate([[True], h[1:end] != h[:end - 1]])[:end]) - 1
            sign = mix64(mix64(a[:end].view(np.uint64))
                         + mix64(b[:end].view(np.uint64) ^ np.uint64(0x9E37)))
            sums = mix64(np.add.reduceat(np.where(ok[:end], sign, np.uint64(0)), starts))
            open_run = np.zeros(len(starts), dtype=bool)  # it may lie in two batches
            open_run[[0, -1]] = True
            own = mix64(h[starts].astype(np.uint64) ^ np.uint64(0xA5A5A5A5))
            key = np.where(open_run, own, sums)
            first = np.zeros(len(starts), dtype=bool)
            first[np.unique(key, return_index=True)[1]] = True
            stay = np.flatnonzero(ok[:end] & (first | open_run)[run_of])
            if len(stay):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[run_of[stay]].astype(np.int64)),
                     binary16(np.column_stack([a[stay], b[stay]]).view(np.uint8))],
                    names=["h", "node"])
        yield from passed

    return in_arrow(dealt, run, "h long, node binary")


def _with_last(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, bool]]:
    """The batches that have rows, and whether each is the last one."""
    held = None
    for batch in batches:
        if batch.num_rows:
            if held is not None:
                yield held, False
            held = batch
    if held is not None:
        yield held, True


def _points(named: DataFrame, outputs: str, size: int, order: Order) -> DataFrame:
    """(node, n, point or set) of the texts of ``named`` (node, t)."""
    kind = {"point binary": pa.binary(), "set array<long>": pa.list_(pa.int64())}[outputs]

    def make():
        def work(texts: pa.Array):
            sets = list(shingle_sets(texts, size, order))
            return [pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([point_of(s) if kind == pa.binary() else s for s in sets], kind)]

        return work

    return add_columns(named, "t", f"n long, {outputs}", make, ["node"])


@F.arrow_udf(T.BooleanType())
def may_link(point_a: pa.Array, point_b: pa.Array, percent: pa.Array) -> pa.Array:
    """The summed coordinate minima of two points allow a link."""
    ok = np.zeros(len(point_a), dtype=bool)
    pairs = list(zip(point_a.to_pylist(), point_b.to_pylist()))
    width = np.array([min(len(a), len(b)) for a, b in pairs], dtype=np.int64)
    for w in np.unique(width).tolist():  # pairs are compared at their coarser resolution
        at = np.flatnonzero(width == w)
        n, c = unpacked([x for i in at.tolist() for x in pairs[i]])
        p = percent.to_numpy(zero_copy_only=False)[at].astype(np.int64)
        ok[at] = overlap_bound(c[::2], c[1::2]) >= needed(n[::2], n[1::2], p)
    return pa.array(ok, pa.bool_())


def _bounded(pairs: DataFrame, points: DataFrame, percent: int) -> DataFrame:
    """The pairs (g, a, b) whose points allow a link."""
    left = points.select(F.col("node").alias("a"), F.col("point").alias("pa"))
    right = points.select(F.col("node").alias("b"), F.col("point").alias("pb"))
    return (pairs.join(left, "a").join(right, "b")
            .filter(may_link("pa", "pb", F.lit(percent).cast("long"))).select("g", "a", "b"))


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets are linked."""
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The linked ones (a, b) of the pairs (g, a, b), on the full sets.

    A set goes once to each group ``g`` that needs it, however many pairs it has there.
    """
    once = pairs.groupBy("a", "b").agg(F.min("g").alias("g"))
    ends = once.select("g", F.explode(F.array("a", "b")).alias("node")).distinct()
    rows = (ends.join(sets.select("node", "set"), "node")
            .select("g", F.col("node").alias("a"), F.lit(None).cast("binary").alias("b"), "set")
            .unionByName(once.select("g", "a", "b",
                                     F.lit(None).cast("array<long>").alias("set"))))

    def work(batch: pa.RecordBatch, starts: np.ndarray) -> list[pa.RecordBatch]:
        g = batch.column("g").to_numpy(zero_copy_only=False)
        first, second = batch.column("a").to_pylist(), batch.column("b").to_pylist()
        held = {(g[i], first[i]): batch.column("set")[i].values.to_numpy()
                for i in range(batch.num_rows) if second[i] is None}
        found = []
        for i in range(batch.num_rows):
            if second[i] is not None:
                if linked(held[g[i], first[i]], held[g[i], second[i]], percent):
                    found.append(i)
        rows = batch.take(pa.array(found, pa.int64())).select(["a", "b"])
        return [rows] if found else []

    return grouped(rows, "g", "a binary, b binary", work)


def _blocks(live: DataFrame, points: DataFrame, percent: int) -> DataFrame:
    """Rows (g, node, comp, point, own, lo, hi): the points of each pair of blocks of a cell.

    A cell is split by size first: a part holds the sets of n in [2^k, 2^(k+1))
    and the larger ones that ``percent`` lets be linked with them. Its
    points are dealt into blocks of about BLOCK; every pair of blocks is a
    group ``g`` of its own, so no task needs a whole cell.
    """
    level = F.floor(F.log2("n")).cast("int")
    least = F.greatest(F.lit(1), F.ceil(F.col("n") * percent / 100))
    parts = F.sequence(F.floor(F.log2(least)).cast("int"), level)
    rows = (live.join(points.select("node", "n", "point"), "node")
            .withColumn("level", level).withColumn("part", F.explode(parts)))
    sizes = rows.groupBy("cell", "part").agg(
        F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"),
        F.count("*").alias("members")).filter("members > 1")
    return (rows.join(sizes, ["cell", "part"])
            .withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumn("lo", F.least("own", "other"))
            .withColumn("hi", F.greatest("own", "other"))
            .withColumn("g", F.xxhash64("cell", "part", "lo", "hi"))
            .select("g", "lo", "hi", "own", "point", *live.columns))


def _leaf_pairs(packed: Sequence[bytes], i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Whether the bound allows a link of the points i and j, at the pairs' coarser resolution."""
    ok = np.zeros(len(i), dtype=bool)
    width = np.array([len(x) for x in packed], dtype=np.int64)
    least = np.minimum(width[i], width[j])
    for w in np.unique(least).tolist():
        at = np.flatnonzero(least == w)
        used, place = np.unique(np.concatenate([i[at], j[at]]), return_inverse=True)
        # the narrowest point gives the others its resolution
        sizes, counts = unpacked([packed[k] for k in used.tolist()])
        x, y = place[:len(at)], place[len(at):]
        n_x, n_y = sizes[x], sizes[y]
        fits = np.flatnonzero(100 * np.minimum(n_x, n_y) >= percent * np.maximum(n_x, n_y))
        step = max(1, (1 << 20) // counts.shape[1])
        for lo in range(0, len(fits), step):  # bounded memory
            k = fits[lo:lo + step]
            ok[at[k]] = overlap_bound(counts[x[k]], counts[y[k]]) >= needed(n_x[k], n_y[k], percent)
    return ok


def _tree_pairs(batch: pa.RecordBatch, starts: np.ndarray, percent: int):
    """(first, second) row numbers of the pairs that the trees of each group let through.

    The trees of groups of one block and one leaf are that leaf alone; they are
    looked through together. Several groups' pairs may come at once.
    """
    packed = batch.column("point").to_pylist()
    own, lo, hi = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("own", "lo", "hi"))
    ends = np.append(starts[1:], batch.num_rows)
    small = (ends - starts <= LEAF) & (lo[starts] == hi[starts])
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for n in np.unique((ends - starts)[small]).tolist():
        first = starts[small & (ends - starts == n)][:, None]
        x, y = np.triu_indices(n, 1)
        left.append((first + x).ravel())
        right.append((first + y).ravel())
    i, j = np.concatenate(left), np.concatenate(right)
    ok = _leaf_pairs(packed, i, j, percent)
    if ok.any():
        yield i[ok], j[ok]
    for a, b in zip(starts[~small].tolist(), ends[~small].tolist()):
        if b - a < 2:
            continue
        left, right = np.flatnonzero(own[a:b] == lo[a]), np.flatnonzero(own[a:b] == hi[a])
        if len(left) and len(right):
            sizes, points = unpacked(packed[a:b])
            tree = CountTree(sizes[left], points[left])
            q, at = tree.search(sizes[right], points[right], percent)
            i, j = a + left[at], a + right[q]
            ok = i < j if lo[a] == hi[a] else i != j
            if ok.any():
                yield i[ok], j[ok]


def _proposed(live: DataFrame, points: DataFrame, percent: int, turn: int) -> DataFrame:
    """(g, cell, node, mate) of the points of ``live`` that the trees give a neighbour.

    ``mate`` is the neighbour of another component that comes first in the
    turn's random order (null if there is none).
    """
    def work(batch: pa.RecordBatch, starts: np.ndarray) -> list[pa.RecordBatch]:
        rank = batch.column("rank").to_numpy(zero_copy_only=False)
        comps = pc.dictionary_encode(batch.column("comp")).indices.to_numpy(zero_copy_only=False)
        mate = np.full(batch.num_rows, -1)
        seen = np.zeros(batch.num_rows, dtype=bool)
        for i, j in _tree_pairs(batch, starts, percent):
            seen[i] = seen[j] = True
            a, b = np.concatenate([i, j]), np.concatenate([j, i])
            other = comps[a] != comps[b]
            a, b = a[other], b[other]
            order = np.lexsort((rank[b], a))
            first = np.ones(len(a), dtype=bool)
            first[1:] = a[order[1:]] != a[order[:-1]]
            mate[a[order[first]]] = b[order[first]]
        at = np.flatnonzero(seen)
        if not len(at):
            return []
        mates = batch.column("node").take(pa.array(mate[at], mask=mate[at] < 0))
        rows = batch.take(pa.array(at))
        return [pa.RecordBatch.from_arrays(
            [rows.column("g"), rows.column("cell"), rows.column("node"), mates],
            names=["g", "cell", "node", "mate"])]

    ranked = live.withColumn("rank", F.xxhash64("node", F.lit(turn)))
    return grouped(_blocks(ranked, points, percent), "g", "g long, cell long, node binary, mate binary",
                   work)


def _between(batch: pa.RecordBatch, starts: np.ndarray, percent: int):
    """The pairs of ``_tree_pairs`` of different components, each in the first cell that it shares."""
    comps = pc.dictionary_encode(batch.column("comp")).indices.to_numpy(zero_copy_only=False)
    cells = batch.column("cell").to_numpy(zero_copy_only=False)
    lists = batch.column("cells")
    sets: dict[int, set[int]] = {}

    def before(i: int) -> set[int]:
        """The cells of the point that come before the row's own."""
        if i not in sets:
            own = lists[i].values.to_numpy()
            sets[i] = set(own[own < cells[i]].tolist())
        return sets[i]

    for left, right in _tree_pairs(batch, starts, percent):
        other = comps[left] != comps[right]
        left, right = left[other], right[other]
        new = np.array([before(i).isdisjoint(before(j))
                        for i, j in zip(left.tolist(), right.tolist())], dtype=bool)
        if new.any():
            yield left[new], right[new]


def _candidates(live: DataFrame, points: DataFrame, percent: int) -> DataFrame:
    """The rows of ``_blocks`` whose point the trees let through with one of another component."""
    lists = live.groupBy("node").agg(F.collect_set("cell").alias("cells"))
    rows = _blocks(live.join(lists, "node"), points, percent)

    def work(batch: pa.RecordBatch, starts: np.ndarray) -> list[pa.RecordBatch]:
        seen = np.zeros(batch.num_rows, dtype=bool)
        for i, j in _between(batch, starts, percent):
            seen[i] = seen[j] = True
        return [batch.filter(pa.array(seen))] if seen.any() else []

    return grouped(rows, "g", rows.schema, work)


def _joined(candidates: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that connect the components of ``candidates``, verified on the full sets.

    The pairs of a group are compared where its sets lie and leave as edges of a
    forest: a pair that the edges found before connect needs no look. So pairs
    never become rows, and a task makes fewer rows than it reads.
    """
    rows = candidates.join(sets.select("node", "set"), "node")

    def work(batch: pa.RecordBatch, starts: np.ndarray) -> list[pa.RecordBatch]:
        comps = pc.dictionary_encode(batch.column("comp")).indices.to_numpy(zero_copy_only=False)
        top = comps.tolist()  # a parent of each component's number
        up = list(range(max(top, default=-1) + 1))

        def root(x: int) -> int:
            while up[x] != x:
                up[x] = up[up[x]]
                x = up[x]
            return x

        lists = batch.column("set")
        values = lists.values.to_numpy()
        edges = lists.offsets.to_numpy()
        first, second = [], []
        for left, right in _between(batch, starts, percent):
            for i, j in zip(left.tolist(), right.tolist()):
                p, q = root(top[i]), root(top[j])
                if p == q:
                    continue
                x, y = values[edges[i]:edges[i + 1]], values[edges[j]:edges[j + 1]]
                if linked(x, y, percent):
                    up[p] = q
                    first.append(i)
                    second.append(j)
        nodes = batch.column("node")
        return [pa.RecordBatch.from_arrays([nodes.take(pa.array(k, pa.int64()))
                                            for k in (first, second)], names=["a", "b"])]

    return grouped(rows, "g", "a binary, b binary", work)


def _some_cells(rows: DataFrame, turn: int) -> DataFrame:
    """``rows`` (cell, node, ...) with a few cells of each node, the same ones for nodes that
    share theirs. Copies and near copies share most cells, so a few connect them.
    """
    place = F.row_number().over(Window.partitionBy("node").orderBy(F.xxhash64("cell", F.lit(turn))))
    return rows.withColumn("i", place).filter(F.col("i") <= FEW_CELLS).drop("i")


def linked_sets(docs: DataFrame, texts: DataFrame, order: Order, *, percent: int = PERCENT,
                size: int = SHINGLE) -> DataFrame:
    """(node, comp) of the sets that are linked with a different set.

    ``docs`` has key and node of every text; ``texts`` has node (the key) and t.
    """
    spark = texts.sparkSession
    rows = _memberships(texts, order, percent, size)
    cells = _cells(rows, percent).select(F.col("h").alias("cell"), "node").distinct()
    cells = reliable_checkpoint(cells)
    release(spark)

    def named(nodes: DataFrame) -> DataFrame:  # one text of each set
        keys = (docs.join(nodes, "node").groupBy("node").agg(F.min("key").alias("key")))
        keys = reliable_checkpoint(keys)
        text = fetch(texts, keys.select(F.col("key").alias("node")))
        return text.join(keys.select("key", F.col("node").alias("set_node")),
                         F.col("node") == F.col("key")).select(F.col("set_node").alias("node"), "t")

    points = reliable_checkpoint(_points(named(cells.select("node").distinct()), "point binary",
                                         size, order))
    release(spark)
    sets = no_rows(spark, "node binary, n long, set array<long>")

    def with_sets(nodes: DataFrame) -> DataFrame:  # and those of the nodes that are not known yet
        more = reliable_checkpoint(nodes.distinct().join(sets, "node", "left_anti"))
        if more.isEmpty():
            return sets
        found = reliable_checkpoint(_points(named(more), "set array<long>", size, order))
        release(spark)
        return sets.unionByName(found.select(*sets.columns))

    start = cells.withColumn("comp", F.col("node"))
    k = cells.groupBy("cell").agg(F.count("*").alias("k"))
    start = reliable_checkpoint(start.join(k, "cell").select(
        "cell", "node", "comp", (F.col("k") > WIDE).alias("wide")))
    few = _some_cells(start.filter("not wide").drop("wide"), 0)
    mates = reliable_checkpoint(_proposed(few, points, percent, 0))
    crowd = start.filter("wide").drop("wide")
    cells = start.select("cell", "node")
    release(spark)
    edges = no_rows(spark, "a binary, b binary")
    before = None
    many = 0 if crowd.isEmpty() else 1  # of the wide cells
    for turn in range(MAX_ROUNDS):
        pairs = no_rows(spark, "g long, a binary, b binary")
        if many:
            some = reliable_checkpoint(_some_cells(crowd, turn))
            pivot = some.groupBy("cell").agg(F.min(F.struct(
                F.xxhash64("node", F.lit(turn)).alias("o"), "node", "comp")).alias("p"),
                F.ceil(F.count("*") / BLOCK).alias("parts"))
            part = F.pmod(F.xxhash64("node"), F.col("parts"))  # a pivot meets a cell in parts
            pairs = _bounded(
                some.join(pivot, "cell").filter("comp <> p.comp").select(
                    F.xxhash64("cell", part).alias("g"), F.least("node", "p.node").alias("a"),
                    F.greatest("node", "p.node").alias("b")), points, percent)
        if mates is not None:
            pairs = pairs.unionByName(mates.filter("mate is not null").select(
                "g", F.least("node", "mate").alias("a"), F.greatest("node", "mate").alias("b")))
        pairs = reliable_checkpoint(pairs)
        sets = with_sets(pairs.select(F.col("a").alias("node")).union(pairs.select("b")))
        edges = reliable_checkpoint(edges.union(_verified(pairs, sets, percent)))
        release(spark)
        comps = reliable_checkpoint(components(edges))
        live = (cells.join(comps, "node", "left")
                .select("cell", "node", F.coalesce("comp", "node").alias("comp")))
        mixed = (live.groupBy("cell").agg(F.min("comp").alias("x"), F.max("comp").alias("y"),
                                          F.count("*").alias("k"))
                 .filter(F.expr("x <> y") & ((F.col("k") > 2) | F.lit(turn == 0))))
        # from the second turn on, a cell of two is settled by its proposals
        live = reliable_checkpoint(
            live.join(mixed.select("cell", (F.col("k") > WIDE).alias("wide")), "cell"))
        left, many = live.agg(F.count("*"), F.count_if("wide")).first()
        if not left:
            return comps
        if turn + 1 >= PROPOSALS and (not many or (before and many > 0.9 * before)):
            break
        before = many
        cells = live.select("cell", "node")
        crowd = live.filter("wide").drop("wide")
        mates = None
        if turn + 1 < PROPOSALS:
            mates = reliable_checkpoint(_proposed(live.filter("not wide").drop("wide"), points,
                                                  percent, turn + 1))
            # members that no tree lets through with another one are done
            cells = reliable_checkpoint(mates.select("cell", "node").distinct()
                                        .unionByName(crowd.select("cell", "node")))
        release(spark)
    live = live.drop("wide")
    near = reliable_checkpoint(_candidates(live, points, percent))
    if near.isEmpty():
        return comps
    sets = with_sets(near.select("node"))
    found = reliable_checkpoint(_joined(near, sets, percent))
    release(spark)
    if found.isEmpty():
        return comps
    return reliable_checkpoint(components(edges.union(found)))


def corpus_order(texts: DataFrame, total: int, size: int = SHINGLE) -> Order:
    """The global order of the shingles of ``texts`` (t), from a bounded sample."""
    plain = shingle_order(texts, total)
    hot = hot_keys(texts, lambda some: _all_shingles(some, size, plain), total)
    return replace(plain, hot=hot)


def shingle_order(texts: DataFrame, total: int, *, sample: int = SAMPLE_TEXTS,
                  words: int = COMMON_WORDS) -> Order:
    """The order by the ``words`` most frequent words of about ``sample`` distinct texts."""
    part = F.pmod(F.xxhash64("t"), F.lit(1 << 40)) / float(1 << 40)
    some = texts.filter(part < sample / max(total, 1)).select("t").distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for found, _ in batch_words(batch.column(0)):
                w, n = np.unique(found, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(w.astype(np.int64)), pa.array(n.astype(np.int64))], names=["w", "n"])

    counts = in_arrow(some, run, "w long, n long").groupBy("w").agg(F.sum("n").alias("n"))
    top = counts.filter("n > 1").orderBy(F.desc("n"), "w").limit(words).collect()
    top.sort(key=lambda r: np.uint64(r["w"] & (1 << 64) - 1))
    return Order(np.array([r["w"] for r in top], dtype=np.int64).astype(np.uint64),
                 np.log2(1 + np.array([r["n"] for r in top], dtype=np.float64)).astype(np.float32),
                 np.zeros(0, np.int64))


def _all_shingles(texts: DataFrame, size: int, order: Order) -> DataFrame:
    def make():
        def work(column: pa.Array):
            sets = list(shingle_sets(column, size, order))
            return [pa.array([node_of(s) for s in sets], pa.binary()),
                    pa.array(sets, pa.list_(pa.int64()))]

        return work

    return add_columns(texts, "t", "node binary, hs array<long>", make, []).select(
        F.explode("hs").alias("h"), "node")


def _keyed(df: DataFrame, text: str, id: str, size: int, order: Order,
           carried: Sequence[str] = ()) -> DataFrame:
    """(id, key, node, n) of every row, with the ``carried`` columns as ``row``."""
    def make():
        def work(column: pa.Array):
            sets = list(shingle_sets(column, size, order))
            return [pa.array([node_of(s) or None for s in sets], pa.binary()),
                    pa.array([len(s) for s in sets], pa.int64())]

        return work

    rows = df.select(F.struct(*[F.col(quoted(c)) for c in carried], F.lit(0).alias("__llm_pad"))
                     .alias("row"), F.col(quoted(id)).alias("id"), text_of(text).alias("t"))
    return add_columns(rows.withColumn("key", text_key(F.col("t"))), "t", "node binary, n long",
                       make, ["row", "id", "key"])


def near_duplicates(df: DataFrame, text: str = "text", id: str = "doc_id", *,
                    percent: int = PERCENT, size: int = SHINGLE,
                    keep: Sequence[str] | None = None) -> DataFrame:
    """Append ``n_shingles`` and ``component``: the smallest id reachable by links.

    Null and empty texts, and texts of spaces only, have empty sets and are
    linked with nothing: their component is their own id. Equal sets are always
    one component. Null ids are ignored in the minimum; a component of null ids
    only has a null one. Rows with one id and different texts stay different.
    """
    kept = [c for c in (df.columns if keep is None else keep)
            if c in others(df, "n_shingles", "component")]
    texts = df.select(text_of(text).alias("t")).withColumn("node", text_key(F.col("t")))
    order = corpus_order(texts, df.count(), size)
    docs = reliable_checkpoint(_keyed(df, text, id, size, order, kept))
    comps = linked_sets(docs.select("key", "node").filter("node is not null"), texts, order,
                        percent=percent, size=size)
    full = docs.filter("node is not null").join(comps, "node", "left").withColumn(
        "comp", F.coalesce("comp", "node"))
    least = full.groupBy("comp").agg(F.min("id").alias("component"))
    done = full.join(least, "comp").select("row", "n", "component").unionByName(
        docs.filter("node is null").select("row", "n", F.col("id").alias("component")))
    return done.select(*[F.col(f"row.{quoted(c)}").alias(c) for c in kept],
                       F.col("n").alias("n_shingles"), "component")


def keep_one(df: DataFrame, text: str = "text", id: str = "doc_id", *, percent: int = PERCENT,
             size: int = SHINGLE) -> DataFrame:
    """The rows of ``df`` with one document of each component, the columns as they are.

    The row with the smallest id stays (of equal ids, one). Texts without words
    are linked with nothing and all stay. Texts are moved once, to drop the
    others; everything else works on keys.
    """
    texts = df.select(text_of(text).alias("t")).withColumn("node", text_key(F.col("t")))
    order = corpus_order(texts, df.count(), size)
    docs = reliable_checkpoint(_keyed(df, text, id, size, order).filter("node is not null")
                               .select("id", "key", "node"))
    comps = linked_sets(docs, texts, order, percent=percent, size=size)
    best = (docs.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
            .groupBy("comp").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key"))
                                 .alias("b"))
            .select(F.col("b.key").alias("key"), F.col("b.id").alias("best")))
    rows = df.select(F.struct(*[F.col(quoted(c)) for c in df.columns]).alias("row"),
                     F.col(quoted(id)).alias("id"), text_key(text_of(text)).alias("key"),
                     text_of(text).alias("t"))
    wordless = F.length(F.translate("t", " \t\n\x0b\x0c\r", "")) == 0
    winners = (rows.filter(~wordless).join(best, "key")
               .filter(F.col("id").eqNullSafe(F.col("best"))).dropDuplicates(["key"]))
    return winners.select("row").unionByName(rows.filter(wordless).select("row")).select(
        *[F.col(f"row.{quoted(c)}").alias(c) for c in df.columns])


def op6_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """Components of all documents over links of similarity 0.8 or more."""
    out = near_duplicates(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return out.select("doc_id", "n_shingles", F.col("component").alias("component_id"))
