"""Exact removal of repeated substrings by distributed suffix sorting.

Every byte covered by a 200-byte string that also starts anywhere else goes.
The method is that of difference-cover suffix sorting, bounded at 200 bytes:
sample suffixes so that two equal strings always share a sample at the same
offset, name the samples, sort what the names leave undecided together with the
other suffixes, and compare neighbours.

* Sample. The cover is chosen by content, not by residue: of the 64-byte
  prefixes in a string's reach the one with the least hash (leftmost first) is
  its sample. Two equal 200-byte strings have the same sample at the same
  offset, and one position in about 69 is a sample; a difference cover modulo
  133 would need 12 of 133.
* Name. A sample whose 64-byte name occurs only once cannot lie in a repeated
  string. One exchange of (name, text, place) finds the names that repeat.
* Merge. Every string of 200 bytes is placed under its sample's name at its
  offset. For each repeated name the strings' keys are sorted; equal
  neighbours are repeats if their bytes are equal, too. Names that very many places hold are sorted by the
  strings' own keys instead, counted before the exchange, so that no task
  gathers them.

Texts are keyed by content, so exact copies are one text that occurs several
times: all of its strings start elsewhere too.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.cache import reliable_checkpoint
from .common import (POWERS, mix64, others, prefix_hash, quoted, raw_bytes, release, table, text_key,
                     text_of, text_slices)
from .repeats import binary16, bytes16, fetch, grouped, hot_keys, is_in, repeated

LENGTH = 200      # bytes of a repeated string
NAME = 64         # bytes of a sample's name
SEGMENT = 1 << 16  # string starts handled at a time (bounds a task's memory)
CROWD = 5000      # places of a name from which its strings are sorted by their own keys
BLOCK = 16        # strings of a crowded name that are compared together first

_OTHER = np.random.default_rng(11).permutation(256).astype(np.uint8)  # for a second hash


def samples(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, name: int = NAME):
    """Runs of string starts with one sample: arrays (place, lo, hi, name hash).

    Positions count in ``data``; every valid start lies in one run [lo, hi).
    """
    reach = length - name + 1
    total = len(data) - length + 1
    out = []
    ends = offsets[1:]
    for lo in range(0, max(0, total), SEGMENT):
        hi = min(total, lo + SEGMENT)
        part = data[lo:hi + length - 1]
        prefix = prefix_hash(part)
        at = np.arange(len(part) - name + 1)
        h = _spans(prefix, at, name)
        key = (h & ~np.uint64((1 << 20) - 1)) | at.astype(np.uint64)  # ties: leftmost
        pad = -len(key) % reach
        blocks = np.concatenate([key, np.full(pad, np.iinfo(np.uint64).max)]).reshape(-1, reach)
        left = np.minimum.accumulate(blocks, axis=1).ravel()
        right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        n = hi - lo
        least = np.minimum(right[:n], left[reach - 1:reach - 1 + n])
        place = (least & np.uint64((1 << 20) - 1)).astype(np.int64)
        starts = np.arange(lo, hi)
        row = np.searchsorted(ends, starts, side="right")  # the text that holds the start
        valid = starts + length <= ends[np.minimum(row, len(ends) - 1)]
        change = np.ones(n, dtype=bool)
        change[1:] = (place[1:] != place[:-1]) | (valid[1:] != valid[:-1]) | (row[1:] != row[:-1])
        first = np.flatnonzero(change)
        last = np.append(first[1:], n)
        ok = valid[first]
        first, last = first[ok], last[ok]
        out.append((place[first] + lo, first + lo, last + lo, h[place[first]]))
    if not out:
        zero = np.zeros(0, np.int64)
        return zero, zero, zero, zero.astype(np.uint64)
    return tuple(np.concatenate(x) for x in zip(*out))


def alike(data: np.ndarray, rows: np.ndarray, lo: np.ndarray, hi: np.ndarray, h: np.ndarray,
          length: int) -> np.ndarray:
    """The rank of each run among the runs of its text with the same name and bytes.

    Runs are ordered by hashes; from the third one on, one that has not the bytes of
    its first gets rank 0 again.
    """
    prefix = prefix_hash(data)
    _, down = POWERS.get(len(prefix))
    whole = mix64((prefix[hi + length - 1] - prefix[lo]) * down[lo] ^ mix64(
        h + (hi - lo).astype(np.uint64)))
    order = np.lexsort((lo, whole, rows))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (whole[order[1:]] != whole[order[:-1]]) | (rows[order[1:]] != rows[order[:-1]])
    first = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order)) - first
    for at in np.flatnonzero(rank[order] > 1).tolist():
        i, j = order[at], order[first[at]]
        if not np.array_equal(data[lo[i]:hi[i] + length - 1], data[lo[j]:hi[j] + length - 1]):
            rank[i] = 0
    return rank


def twins(raw: bytes, length: int, name: int) -> list[tuple[int, int]]:
    """Starts [lo, hi) of the runs that stand at least twice in one text."""
    _, lo, hi, _ = samples(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), length, name)
    found = Counter()
    runs = list(zip(lo.tolist(), hi.tolist()))
    for a, b in runs:
        found[raw[a:b + length - 1]] += 1
    return [(a, b) for a, b in runs if found[raw[a:b + length - 1]] > 1]


def _spans(prefix: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    _, down = POWERS.get(len(prefix))
    return mix64((prefix[starts + width] - prefix[starts]) * down[starts])


def _slices(batch_texts: pa.Array, limit: int = 1 << 19):
    """(first row, row count, bytes, offsets) of parts of a batch of about ``limit`` bytes."""
    data, offsets = raw_bytes(batch_texts)
    for lo, hi in text_slices(offsets, limit):
        yield lo, hi - lo, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]


def _names(texts: DataFrame, length: int, name: int) -> DataFrame:
    """(h, node, place): the samples of each text (node, t), once per task and text.

    Of runs that a text repeats byte for byte two are enough: they show that
    the run repeats, and ``twins`` finds the others in the text itself.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            keys = batch.column(0).to_pylist()
            fresh = np.zeros(len(keys), dtype=bool)
            for i, k in enumerate(keys):
                if k not in seen:
                    seen.add(k)
                    fresh[i] = True
            if not fresh.any():
                continue
            chosen = batch.filter(pa.array(fresh))
            nodes = bytes16(chosen.column(0))
            for lo, n, data, offsets in _slices(chosen.column(1)):
                place, first, last, h = samples(data, offsets, length, name)
                if not len(place):
                    continue
                row = np.searchsorted(offsets, place, side="right") - 1
                few = alike(data, row, first, last, h, length) < 2
                place, h, row = place[few], h[few], row[few]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.astype(np.int64)), binary16(nodes[lo + row]),
                     pa.array((place - offsets[row]).astype(np.int32))],
                    names=["h", "node", "place"])

    return texts.select("node", "t").mapInArrow(run, "h long, node binary, place int")


def _contexts(held: DataFrame, length: int, name: int) -> DataFrame:
    """(h, crowd, node, lo, off, bytes): the strings around each named place of a text.

    ``held`` has node, t and places (struct of place and crowd). ``lo`` is the
    first start, ``off`` its distance to the sample; the strings are those that
    fit into ``bytes``.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                places = batch.column(2)[i].as_py()
                wanted = np.array([p["place"] for p in places], dtype=np.int64)
                crowd = np.array([p["crowd"] for p in places], dtype=bool)
                order = np.argsort(wanted)
                wanted, crowd = wanted[order], crowd[order]
                node, raw = batch.column(0)[i].as_py(), batch.column(1)[i].as_py().encode()
                data = np.frombuffer(raw, np.uint8)
                place, lo, hi, h = samples(data, np.array([0, len(data)]), length, name)
                at = np.minimum(np.searchsorted(wanted, place), max(0, len(wanted) - 1))
                ok = wanted[at] == place
                place, lo, hi, h, at = place[ok], lo[ok], hi[ok], h[ok], at[ok]
                if not len(place):
                    continue
                cut = [raw[a:b + length - 1] for a, b in zip(lo.tolist(), hi.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.astype(np.int64)), pa.array(crowd[at]),
                     pa.array([node] * len(place), pa.binary()), pa.array(lo.astype(np.int32)),
                     pa.array((place - lo).astype(np.int32)), pa.array(cut, pa.binary())],
                    names=["h", "crowd", "node", "lo", "off", "bytes"])

    return held.select("node", "t", "places").mapInArrow(
        run, "h long, crowd boolean, node binary, lo int, off int, bytes binary")


def _string_keys(batch: pa.RecordBatch, length: int):
    """(row, start, key, place, data) of all strings of context rows.

    The key joins name, offset and bytes; ``place`` is the string's place in ``data``.
    """
    cut = batch.column("bytes")
    sizes = np.array([len(x) for x in cut.to_pylist()], dtype=np.int64)
    data = np.frombuffer(b"".join(cut.to_pylist()), np.uint8)
    base = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    count = sizes - length + 1
    row = np.repeat(np.arange(len(sizes)), count)
    step = np.arange(len(row)) - np.repeat(np.concatenate([[0], np.cumsum(count)])[:-1], count)
    # shared prefix sums would cross rows: positions inside data are enough, spans stay in a row
    place = base[row] + step
    key = _spans(prefix_hash(data), place, length)
    h = batch.column("h").to_numpy(zero_copy_only=False).astype(np.uint64)
    off = batch.column("off").to_numpy(zero_copy_only=False).astype(np.int64)
    rel = (off[row] - step).astype(np.uint64)
    lo = batch.column("lo").to_numpy(zero_copy_only=False).astype(np.int64)
    key = mix64(key ^ mix64(h[row] + rel * np.uint64(0x9FB21C651E98DF25)))
    return row, lo[row] + step, key, place, data


def same_strings(key: np.ndarray, row: np.ndarray, place: np.ndarray, data: np.ndarray,
                 length: int) -> np.ndarray:
    """Which strings stand twice: equal keys, and equal bytes.

    Neighbours in the order of the keys are compared, whole stretches at once where
    the neighbours of one string are next to those of the string before it. Where
    bytes differ under one key, its strings are told apart by their bytes.
    """
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    i, j = order[:-1][same], order[1:][same]
    marked = np.zeros(len(key), dtype=bool)
    marked[i] = marked[j] = True
    if not len(i):
        return marked
    by_place = np.argsort(place[i], kind="stable")
    i, j = i[by_place], j[by_place]
    p, q = place[i], place[j]
    new = np.ones(len(i), dtype=bool)
    new[1:] = ((p[1:] != p[:-1] + 1) | (q[1:] != q[:-1] + 1) | (row[i[1:]] != row[i[:-1]])
               | (row[j[1:]] != row[j[:-1]]))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(i)) - 1
    wrong = []
    for a, b, c, d, f, g in zip(p[first].tolist(), p[last].tolist(), q[first].tolist(),
                                q[last].tolist(), first.tolist(), last.tolist()):
        if not np.array_equal(data[a:b + length], data[c:d + length]):
            wrong += key[i[f:g + 1]].tolist()
    if wrong:
        crowd = np.flatnonzero(np.isin(key, np.unique(np.array(wrong, dtype=np.uint64))))
        strings = [(int(key[x]), data[place[x]:place[x] + length].tobytes()) for x in crowd]
        count = Counter(strings)
        marked[crowd] = [count[x] > 1 for x in strings]
    return marked


def _runs(batch: pa.RecordBatch, row: np.ndarray, start: np.ndarray) -> pa.RecordBatch | None:
    """(node, lo, hi) of runs of consecutive marked starts of one context row."""
    if not len(row):
        return None
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(row)) - 1
    return pa.RecordBatch.from_arrays(
        [batch.column("node").take(pa.array(row[first])),
         pa.array(start[first].astype(np.int32)), pa.array((start[last] + 1).astype(np.int32))],
        names=["node", "lo", "hi"])


def _sorted_in_groups(contexts: DataFrame, length: int) -> DataFrame:
    """(node, lo, hi): repeated starts, by sorting the strings of each name in place."""
    def work(batch: pa.RecordBatch, _) -> list[pa.RecordBatch]:
        row, start, key, place, data = _string_keys(batch, length)
        marked = same_strings(key, row, place, data, length)
        out = _runs(batch, row[marked], start[marked])
        return [] if out is None else [out]

    return grouped(contexts, "h", "node binary, lo int, hi int", work, rows_at_once=2000)


def _told_apart(rows: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """Equal rows (h, off, node, lo, bytes, open) counted: (node, lo, hi) of the open ones that
    repeat, and each distinct row once, open if it was and does not repeat.

    A row holds all strings that fit into its bytes; if the bytes stand twice at
    one distance from the name, all of its strings repeat.
    """
    same = ["h", "off", "ck"]
    named = rows.withColumn("ck", F.md5("bytes"))
    distinct = reliable_checkpoint(named.groupBy(*same).agg(
        F.count("*").alias("n"), F.min(F.struct("node", "lo", "bytes", "open")).alias("one")))
    end = F.col("lo") + F.octet_length("bytes") - (length - 1)
    marked = named.filter("open").join(distinct.filter("n > 1").select(*same), same).select(
        "node", "lo", end.cast("int").alias("hi"))
    return marked, distinct.select("h", "off", "one.node", "one.lo", "one.bytes",
                                   (F.col("one.open") & (F.col("n") == 1)).alias("open"))


def _in_blocks(contexts: DataFrame, length: int) -> DataFrame:
    """The contexts cut into rows of up to BLOCK starts, at the same distances from the name."""
    first = F.col("off") % BLOCK + 1 - BLOCK  # the block of the first start may be a part of one
    count = F.octet_length("bytes") - (length - 1)
    cut = contexts.withColumn("count", count).withColumn(
        "cut", F.explode(F.sequence(first, F.col("count") - 1, F.lit(BLOCK))))
    cut = cut.withColumn("a", F.greatest("cut", F.lit(0))).withColumn(
        "b", F.least(F.col("cut") + BLOCK, "count"))
    return cut.select("h", "node", "open", (F.col("off") - F.col("a")).alias("off"),
                      (F.col("lo") + F.col("a")).alias("lo"),
                      F.substring("bytes", F.col("a") + 1, F.col("b") - F.col("a") + length - 1)
                      .alias("bytes"))


def _sorted_by_key(contexts: DataFrame, length: int) -> DataFrame:
    """(node, lo, hi): repeated starts of crowded names, counted by the strings' keys.

    Equal contexts are counted first, before the exchange, then equal blocks of
    the distinct contexts: all of their strings repeat. The strings of each
    distinct block are then counted by their own keys, and those of the blocks
    that are still open are marked one by one, so no task gathers a name.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 2000):
                part = pa.Table.from_batches([batch.slice(lo, 2000)]).combine_chunks().to_batches()[0]
                row, start, key, place, data = _string_keys(part, length)
                # a second hash, of other values of the bytes: 128 bits tell strings apart
                more = _spans(prefix_hash(_OTHER[data]), place, length)
                took = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.astype(np.int64)), pa.array(more.astype(np.int64)),
                     part.column("node").take(took), pa.array(start.astype(np.int32)),
                     part.column("open").take(took)],
                    names=["k", "k2", "node", "lo", "open"])

    whole, distinct = _told_apart(contexts.withColumn("open", F.lit(True)), length)
    parts, blocks = _told_apart(_in_blocks(distinct, length), length)
    keys = blocks.mapInArrow(run, "k long, k2 long, node binary, lo int, open boolean")
    often = keys.groupBy("k", "k2").agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    single = keys.filter("open").join(often, ["k", "k2"]).select("node", "lo",
                                                         (F.col("lo") + 1).alias("hi"))
    return whole.unionByName(parts).unionByName(single)


def repeated_runs(texts: DataFrame, *, length: int = LENGTH, name: int = NAME,
                  crowd: int = CROWD, total: int | None = None) -> DataFrame:
    """(node, spans): the starts [lo, hi) in each distinct text of strings that start elsewhere too.

    ``texts`` has node (content key) and t; copies of a text count once here.
    """
    total = texts.count() if total is None else total
    hot = hot_keys(texts.select("t"), lambda some: _names(
        some.withColumn("node", text_key(F.col("t"))), length, name).select("h", "node"), total)
    found = _names(texts, length, name)
    if len(hot):
        @F.arrow_udf("boolean")
        def is_hot(h: pa.Array) -> pa.Array:
            return pa.array(is_in(hot, h.to_numpy(zero_copy_only=False)))

        flagged = found.withColumn("hot", is_hot("h"))
        crowded = flagged.filter("hot").select("h", "node", "place").distinct()
        named = repeated(flagged.filter("not hot"), "h", ["node", "place"]).withColumn(
            "crowd", F.lit(False)).unionByName(crowded.withColumn("crowd", F.lit(True)))
    else:
        named = repeated(found, "h", ["node", "place"]).withColumn("crowd", F.lit(False))
    named = reliable_checkpoint(named)
    release(texts.sparkSession)
    big = named.filter("not crowd").groupBy("h").agg(F.count("*").alias("n")).filter(
        F.col("n") > crowd).select("h", F.lit(True).alias("big"))
    places = (named.join(big, "h", "left")
              .select("node", F.struct("place", (F.col("crowd") | F.coalesce("big", F.lit(False)))
                                       .alias("crowd")).alias("p"))
              .groupBy("node").agg(F.collect_list("p").alias("places")))
    held = fetch(texts, named.select("node").distinct()).join(places, "node")
    def contexts(wanted: str) -> DataFrame:  # of the places for which ``wanted`` holds only
        part = held.withColumn("places", F.expr(f"filter(places, p -> {wanted})"))
        return _contexts(part.filter(F.size("places") > 0), length, name)

    spans = _sorted_in_groups(contexts("not p.crowd"), length)
    if len(hot) or big.limit(1).count():
        crowded = reliable_checkpoint(contexts("p.crowd"))  # read three times, found once
        spans = spans.unionByName(_sorted_by_key(crowded, length))
    return spans.groupBy("node").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))


def covered(spans: Sequence[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """Maximal byte runs covered by the strings that start in the spans."""
    out: list[list[int]] = []
    for lo, hi in sorted(spans):
        end = hi - 1 + length
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([lo, end])
    return [(a, b) for a, b in out]


def remove_repeats(df: DataFrame, text: str = "text", *, length: int = LENGTH, name: int = NAME,
                   crowd: int = CROWD, keep: Sequence[str] | None = None) -> DataFrame:
    """Append ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept_sha256``.

    Texts are UTF-8 bytes (null: empty). Texts shorter than ``length`` keep all.
    Of a text that stands in several rows nothing is kept if it is that long.
    Strings are judged on the input; overlaps count; a maximal run of removed
    bytes is one span. What is kept need not be valid UTF-8 (see ``kept_of``).
    """
    kept = [c for c in (df.columns if keep is None else keep)
            if c in others(df, "n_bytes", "n_removed", "n_spans", "kept_sha256")]
    texts = df.select(text_of(text).alias("t")).withColumn("node", text_key(F.col("t")))
    texts = texts.filter(F.octet_length("t") >= length)
    rows = df.select(F.struct(*[F.col(quoted(c)) for c in kept], F.lit(0).alias("__llm_pad"))
                     .alias("row"), text_key(text_of(text)).alias("node"),
                     F.octet_length(text_of(text)).cast("long").alias("n_bytes"),
                     F.sha2(text_of(text), 256).alias("whole"))
    spans = reliable_checkpoint(repeated_runs(texts, length=length, name=name, crowd=crowd))
    release(df.sparkSession)
    held = fetch(texts, spans.select("node")).join(spans, "node")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                raw = batch.column(1)[i].as_py().encode()
                starts = [(s["lo"], s["hi"]) for s in batch.column(2)[i].as_py()]
                gone = covered(starts + twins(raw, length, name), length)
                rest = kept_of(raw, gone)
                out.append((batch.column(0)[i].as_py(), len(raw) - len(rest), len(gone),
                            hashlib.sha256(rest).hexdigest()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[k] for o in out], kind) for k, kind in enumerate(
                    (pa.binary(), pa.int64(), pa.int64(), pa.string()))],
                names=["node", "gone", "runs", "left"])

    results = held.select("node", "t", "spans").mapInArrow(
        cut, "node binary, gone long, runs long, left string")
    copies = (rows.filter(F.col("n_bytes") >= length).groupBy("node")
              .agg(F.count("*").alias("copies")).filter("copies > 1"))
    verdict = results.join(copies, "node", "full")
    out = rows.join(verdict, "node", "left")
    copied = F.col("copies").isNotNull()
    return out.select(
        *[F.col(f"row.{quoted(c)}").alias(c) for c in kept], "n_bytes",
        F.when(copied, F.col("n_bytes")).otherwise(F.coalesce("gone", F.lit(0)))
        .cast("long").alias("n_removed"),
        F.when(copied, F.lit(1)).otherwise(F.coalesce("runs", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copied, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("left", "whole"))
        .alias("kept_sha256"))


def kept_of(raw: bytes, gone: Sequence[tuple[int, int]]) -> bytes:
    """The bytes outside the removed runs, concatenated."""
    parts, done = [], 0
    for a, b in gone:
        parts.append(raw[done:a])
        done = b
    return b"".join([*parts, raw[done:]])


def op10_repeated_substrings(spark, sf_dir: str) -> DataFrame:
    """Every document without the bytes of 200-byte strings that start elsewhere too."""
    return remove_repeats(table(spark, sf_dir, "documents"), keep=["doc_id"])
