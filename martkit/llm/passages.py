"""Exact removal of repeated word passages by prefix-partitioned suffix trees.

Every word covered by a window of 35 words that also starts anywhere else goes.

* Sample. Of the 24 places in a window from which 12 words can be read, the one
  whose 12 words hash least (leftmost first) is the window's sample, so equal
  windows have their sample at the same place. About one suffix in twelve is
  sampled; one whose 12 words stand nowhere else is dropped at once.
* Partition. The suffixes are split by a prefix of variable length: the 12 words
  where at most ``group`` suffixes share them, else 28 words, which splits the
  windows around the sample into three classes by their distance to it, else the
  whole window, counted before the exchange instead of gathered.
* Trees. The suffixes of a group are sorted by their words; the words that
  neighbours share (LCP) are the depths of the inner nodes. The same is done with
  the words before the sample, read backwards. A window with o words before its
  sample repeats where another suffix lies below the same node at depth 35 - o
  and, backwards, below the same node at depth o: words are compared, not hashes.

Texts are keyed by content, so exact copies are one text that occurs several
times: all of its windows start elsewhere too.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.cache import reliable_checkpoint
from .common import (others, prefix_hash, quoted, release, span_hash, table, text_key, text_of,
                     window_hash)
from .repeats import binary16, bytes16, fetch, grouped, hot_keys, is_in, repeated
from .words import Words, WordSums, word_slices

WINDOW = 35        # words of a repeated window
NAME = 12          # words of a sample's prefix
CLASS = 8          # distances to the sample that a longer prefix holds together
GROUP = 4096       # suffixes of a prefix up to which a tree is built
SEGMENT = 1 << 18  # window starts handled at a time (bounds a task's memory)

_PLACE = np.uint64((1 << 20) - 1)


def samples(hashes: np.ndarray, first: np.ndarray, window: int = WINDOW, name: int = NAME):
    """Runs of window starts with one sample: arrays (place, lo, hi, prefix hash).

    ``hashes`` has the word hashes of some texts, ``first`` where each begins.
    Every window inside a text lies in exactly one run [lo, hi).
    """
    reach = window - name + 1
    total = len(hashes) - window + 1
    ends, out = first[1:], []
    for lo in range(0, max(0, total), SEGMENT):
        hi = min(total, lo + SEGMENT)
        h = window_hash(hashes[lo:hi + window - 1], name)
        key = (h & ~_PLACE) | np.arange(len(h)).astype(np.uint64)  # ties: leftmost
        pad = np.full(-len(key) % reach, np.iinfo(np.uint64).max)
        blocks = np.concatenate([key, pad]).reshape(-1, reach)
        left = np.minimum.accumulate(blocks, axis=1).ravel()
        right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        n = hi - lo
        place = (np.minimum(right[:n], left[reach - 1:reach - 1 + n]) & _PLACE).astype(np.int64)
        starts = np.arange(lo, hi)
        row = np.searchsorted(ends, starts, side="right")
        valid = starts + window <= ends[row]
        change = np.ones(n, dtype=bool)
        change[1:] = (place[1:] != place[:-1]) | (valid[1:] != valid[:-1]) | (row[1:] != row[:-1])
        begin = np.flatnonzero(change)
        stop = np.append(begin[1:], n)
        ok = valid[begin]
        begin, stop = begin[ok], stop[ok]
        out.append((place[begin] + lo, begin + lo, stop + lo, h[place[begin]]))
    if not out:
        zero = np.zeros(0, np.int64)
        return zero, zero, zero, zero.astype(np.uint64)
    return tuple(np.concatenate(x) for x in zip(*out))


def _sampled(words: Words, window: int, name: int):
    """``samples`` of a slice."""
    prefix = prefix_hash(words.data)
    return samples(span_hash(prefix, words.starts, words.ends), words.first, window, name)


def _alike(ids: np.ndarray, row: np.ndarray, lo: np.ndarray, hi: np.ndarray, window: int
           ) -> np.ndarray:
    """A number for each run of windows, equal for runs of one text with equal words."""
    key = np.rec.fromarrays([row, hi - lo, WordSums(ids).spans(lo, hi + window - 1)])
    _, code = np.unique(key, return_inverse=True)
    code = code.astype(np.int64)
    head = np.full(int(code.max()) + 1 if len(code) else 0, -1, dtype=np.int64)
    fresh = len(head)
    for i, c in enumerate(code.tolist()):  # runs with one hash are compared word by word
        j = head[c]
        if j < 0:
            head[c] = i
        elif not np.array_equal(ids[lo[i]:hi[i] + window - 1], ids[lo[j]:hi[j] + window - 1]):
            code[i] = fresh
            fresh += 1
    return code


def _rank(code: np.ndarray) -> np.ndarray:
    """How many equal numbers stand before each."""
    order = np.argsort(code, kind="stable")
    new = np.ones(len(code), dtype=bool)
    new[1:] = code[order[1:]] != code[order[:-1]]
    first = np.maximum.accumulate(np.where(new, np.arange(len(code)), 0))
    rank = np.empty(len(code), dtype=np.int64)
    rank[order] = np.arange(len(code)) - first
    return rank


def _names(texts: DataFrame, window: int, name: int) -> DataFrame:
    """(h, node, place): the sampled suffixes of each text (node, t), once per task and text.

    Of runs of windows that a text repeats word for word two are enough: they
    show that the run repeats, and ``twins`` finds the others in the text itself.
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
            for at, words in word_slices(chosen.column(1)):
                place, lo, hi, h = _sampled(words, window, name)
                if not len(place):
                    continue
                row = np.searchsorted(words.first, place, side="right") - 1
                again = _rank(np.unique(np.rec.fromarrays([row, h]), return_inverse=True)[1]) > 0
                if again.any():  # else no run can stand twice in its text
                    few = _rank(_alike(words.ids(), row, lo, hi, window)) < 2
                    place, h, row = place[few], h[few], row[few]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.astype(np.int64)), binary16(nodes[at + row]),
                     pa.array((place - words.first[row]).astype(np.int32))],
                    names=["h", "node", "place"])

    return texts.select("node", "t").mapInArrow(run, "h long, node binary, place int")


def _suffixes(held: DataFrame, window: int, name: int) -> DataFrame:
    """(k, crowd, node, lo, off, n, words): the windows around each sampled suffix of a text.

    ``held`` has node, t and places (struct of place and crowd). The words hold n
    windows that start at ``lo`` and after; the suffix starts ``off`` words later.
    A crowded prefix is made longer: one row for each class of distances, under
    the words that all windows of the class share.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                wanted = {p["place"]: p["crowd"] for p in batch.column(2)[i].as_py()}
                node = batch.column(0)[i].as_py()
                (_, words), = word_slices(batch.column(1).slice(i, 1))
                rows = []
                for place, lo, hi, h in zip(*(x.tolist() for x in _sampled(words, window, name))):
                    if place not in wanted:
                        continue
                    if not wanted[place]:
                        rows.append((h, False, lo, hi, place))
                        continue
                    for c in range(0, window - name + 1, CLASS):
                        a, b = max(lo, place - c - CLASS + 1), min(hi, place - c + 1)
                        if a < b:
                            core = place - c
                            text = _text(words, core, core + window - CLASS + 1)
                            k = hashlib.blake2b(text, digest_size=8, salt=b"%d" % c).digest()
                            rows.append((int.from_bytes(k, "big"), True, a, b, core))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.array([r[0] for r in rows], dtype=np.uint64).astype(np.int64)),
                     pa.array([r[1] for r in rows], pa.bool_()),
                     pa.array([node] * len(rows), pa.binary()),
                     *(pa.array(x, pa.int32()) for x in (
                         [r[2] for r in rows], [r[4] - r[2] for r in rows],
                         [r[3] - r[2] for r in rows])),
                     pa.array([_text(words, r[2], r[3] + window - 1) for r in rows], pa.binary())],
                    names=["k", "crowd", "node", "lo", "off", "n", "words"])

    return held.select("node", "t", "places").mapInArrow(
        run, "k long, crowd boolean, node binary, lo int, off int, n int, words binary")


def _text(words: Words, lo: int, hi: int) -> bytes:
    """The words lo to hi - 1, joined by one space."""
    whole = words.data[words.starts[lo]:words.ends[hi - 1]].tobytes()
    return b" ".join(whole.split())


def inner_nodes(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the rows and the columns that neighbours in it share (LCP, n - 1 values)."""
    wide = np.ascontiguousarray(matrix.astype(">u4")).view(f"V{4 * matrix.shape[1]}").ravel()
    order = np.argsort(wide, kind="stable") if len(wide) else np.zeros(0, np.int64)
    ranked = matrix[order]
    same = np.logical_and.accumulate(ranked[1:] == ranked[:-1], axis=1)
    return order, same.sum(axis=1)


def _below(order: np.ndarray, lcp: np.ndarray, depth: int) -> np.ndarray:
    """For each row the number of its ancestor at ``depth``."""
    out = np.empty(len(order), dtype=np.int64)
    out[order] = np.concatenate([[0], np.cumsum(lcp < depth)]) if len(order) else order
    return out


def repeated_windows(group: np.ndarray, ids: np.ndarray, base: np.ndarray, off: np.ndarray,
                     n: np.ndarray, window: int, name: int) -> np.ndarray:
    """(rows, reach) marks: column o says that the row's window with o words before its suffix
    stands in another row of the group, too.

    Row r has the word numbers ``ids[base[r]:base[r + 1]]``, n windows that start at
    its first word and after, and its suffix at ``off``.
    """
    reach = window - name + 1
    rows = len(group)
    size = np.diff(base)
    ahead = np.arange(window)
    at = off[:, None] + ahead
    last = max(0, len(ids) - 1)
    right = np.where(at < size[:, None], ids[np.minimum(base[:-1, None] + at, last)] + 1, 0)
    back = off[:, None] - 1 - np.arange(reach)
    left = np.where(back >= 0, ids[np.maximum(base[:-1, None] + back, 0)] + 1, 0)
    forward = inner_nodes(np.column_stack([group, right]))
    backward = inner_nodes(np.column_stack([group, left]))
    marks = np.zeros((rows, reach), dtype=bool)
    for o in range(reach):
        here = np.flatnonzero((o <= off) & (o > off - n))
        if len(here) < 2:
            continue
        below = _below(*forward, 1 + window - o)[here]
        many = np.bincount(below, minlength=rows)[below] > 1  # an inner node that deep
        here, below = here[many], below[many]
        both = below * rows + _below(*backward, 1 + o)[here]
        _, code, count = np.unique(both, return_inverse=True, return_counts=True)
        marks[here[count[code] > 1], o] = True
    return marks


def _in_trees(suffixes: DataFrame, window: int, name: int) -> DataFrame:
    """(node, lo, hi): repeated window starts, from the tree of each prefix."""
    def work(batch: pa.RecordBatch, starts: np.ndarray) -> list[pa.RecordBatch]:
        many = np.diff(np.append(starts, batch.num_rows)) > 1
        group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, batch.num_rows)))
        some = np.flatnonzero(many[group])
        if not len(some):
            return []
        batch, group = batch.take(pa.array(some)), group[some]
        (_, words), = word_slices(batch.column("words").cast(pa.large_string()), limit=1 << 62)
        off, n, lo = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64)
                      for c in ("off", "n", "lo"))
        marks = repeated_windows(group, words.ids(), words.first, off, n, window, name)
        row, o = np.nonzero(marks[:, ::-1])  # windows in ascending order
        o = marks.shape[1] - 1 - o
        if not len(row):
            return []
        start = lo[row] + off[row] - o
        new = np.ones(len(row), dtype=bool)
        new[1:] = (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1)
        begin = np.flatnonzero(new)
        stop = np.append(begin[1:], len(row)) - 1
        return [pa.RecordBatch.from_arrays(
            [batch.column("node").take(pa.array(row[begin])),
             pa.array(start[begin].astype(np.int32)), pa.array((start[stop] + 1).astype(np.int32))],
            names=["node", "lo", "hi"])]

    return grouped(suffixes, "k", "node binary, lo int, hi int", work)


def _by_whole_window(suffixes: DataFrame, window: int) -> DataFrame:
    """(node, lo, hi): repeated window starts of prefixes that are too many for a tree.

    Equal rows are counted first; of those that stand once the windows are counted
    one by one by the digest of their words. Both counts combine before the exchange.
    """
    same = ["k", "off", "n", "ck"]
    rows = suffixes.withColumn("ck", F.md5("words"))
    distinct = reliable_checkpoint(rows.groupBy(*same).agg(
        F.count("*").alias("copies"), F.min(F.struct("node", "lo", "words")).alias("one")))
    whole = rows.join(distinct.filter("copies > 1").select(*same), same).select(
        "node", "lo", (F.col("lo") + F.col("n")).alias("hi"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for open_, node, lo, n, words in zip(*(c.to_pylist() for c in batch.columns)):
                w = words.split(b" ")
                out += [(hashlib.md5(b" ".join(w[i:i + window])).digest(), open_, node, lo + i)
                        for i in range(n)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in out], kind) for k, kind in enumerate(
                    (pa.binary(), pa.bool_(), pa.binary(), pa.int32()))],
                names=["w", "open", "node", "lo"])

    windows = distinct.select((F.col("copies") == 1).alias("open"), "one.node", "one.lo", "n",
                              "one.words").mapInArrow(
        run, "w binary, open boolean, node binary, lo int")
    often = windows.groupBy("w").agg(F.count("*").alias("n")).filter("n > 1").select("w")
    single = windows.filter("open").join(often, "w").select(
        "node", "lo", (F.col("lo") + 1).alias("hi"))
    return whole.unionByName(single)


def _flagged(rows: DataFrame, key: str, group: int, flag: str) -> DataFrame:
    """``rows`` with ``flag``: whether their key has more than ``group`` rows."""
    big = rows.groupBy(key).agg(F.count("*").alias("c")).filter(F.col("c") > group)
    return rows.join(big.select(key, F.lit(True).alias(flag)), key, "left").withColumn(
        flag, F.coalesce(flag, F.lit(False)))


def repeated_spans(texts: DataFrame, *, window: int = WINDOW, name: int = NAME,
                   group: int = GROUP) -> DataFrame:
    """(node, spans): the starts [lo, hi) in each distinct text of windows that start elsewhere too.

    ``texts`` has node (content key) and t; copies of a text count once here.
    """
    hot = hot_keys(texts.select("t"), lambda some: _names(
        some.withColumn("node", text_key(F.col("t"))), window, name).select("h", "node"),
        texts.count())
    found = _names(texts, window, name)
    if len(hot):
        @F.arrow_udf("boolean")
        def is_hot(h: pa.Array) -> pa.Array:
            return pa.array(is_in(hot, h.to_numpy(zero_copy_only=False)))

        marked = found.withColumn("hot", is_hot("h"))
        named = repeated(marked.filter("not hot"), "h", ["node", "place"]).withColumn(
            "hot", F.lit(False)).unionByName(marked.filter("hot").distinct())
    else:
        named = repeated(found, "h", ["node", "place"]).withColumn("hot", F.lit(False))
    named = reliable_checkpoint(named)
    release(texts.sparkSession)
    crowd = F.col("hot") | F.col("big")
    places = (_flagged(named, "h", group, "big")
              .select("node", F.struct("place", crowd.alias("crowd")).alias("p"))
              .groupBy("node").agg(F.collect_list("p").alias("places")))
    held = fetch(texts, named.select("node").distinct()).join(places, "node")
    suffixes = reliable_checkpoint(_suffixes(held, window, name))
    release(texts.sparkSession)
    small, crowded = suffixes.filter("not crowd"), suffixes.filter("crowd")
    spans = [_in_trees(small, window, name)]
    if crowded.limit(1).count():
        crowded = _flagged(crowded, "k", group, "huge")
        spans += [_in_trees(crowded.filter("not huge").drop("huge"), window, name),
                  _by_whole_window(crowded.filter("huge"), window)]
    out = spans[0]
    for more in spans[1:]:
        out = out.unionByName(more)
    return out.groupBy("node").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))


def twins(words: Words, window: int, name: int) -> list[tuple[int, int]]:
    """Starts [lo, hi) of the runs of windows that stand at least twice in one text."""
    _, lo, hi, _ = _sampled(words, window, name)
    if not len(lo):
        return []
    code = _alike(words.ids(), np.zeros(len(lo), np.int64), lo, hi, window)
    twice = np.bincount(code)[code] > 1
    return list(zip(lo[twice].tolist(), hi[twice].tolist()))


def uncovered(n: int, spans: Sequence[tuple[int, int]], window: int) -> np.ndarray:
    """Of n words, those that no window which starts in the spans covers."""
    mark = np.zeros(n + 1, dtype=np.int64)
    for lo, hi in spans:
        mark[lo] += 1
        mark[hi - 1 + window] -= 1
    return np.cumsum(mark[:-1]) == 0


def remove_passages(df: DataFrame, text: str = "text", *, window: int = WINDOW, name: int = NAME,
                    group: int = GROUP, keep: Sequence[str] | None = None) -> DataFrame:
    """Append ``n_words``, ``n_removed`` and ``kept_sha256``.

    Words are runs of bytes other than space and 0x09-0x0D (null and empty texts
    have none). Texts of fewer than ``window`` words keep all; of a text that
    stands in several rows nothing is kept if it is that long. Windows are judged
    on the input; overlaps count, in the same text too. Kept words are joined by
    one space. Clashing input columns are replaced.
    """
    kept = [c for c in (df.columns if keep is None else keep)
            if c in others(df, "n_words", "n_removed", "kept_sha256")]
    texts = df.select(text_of(text).alias("t")).withColumn("node", text_key(F.col("t")))
    texts = texts.filter(F.octet_length("t") >= 2 * window - 1)
    source = df.select(F.struct(*[F.col(quoted(c)) for c in kept], F.lit(0).alias("__llm_pad"))
                       .alias("row"), text_key(text_of(text)).alias("node"), text_of(text).alias("t"))
    schema = source.drop("t").schema.add("n_words", "long").add("whole", "string")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, whole = [], []
            for _, words in word_slices(batch.column(2)):
                n += np.diff(words.first).tolist()
                whole += words.digests(np.ones(len(words.starts), dtype=bool))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()),
                 pa.array(whole, pa.string())], names=["row", "node", "n_words", "whole"])

    rows = reliable_checkpoint(source.mapInArrow(count, schema))
    spans = reliable_checkpoint(repeated_spans(texts, window=window, name=name, group=group))
    release(df.sparkSession)
    held = fetch(texts, spans.select("node")).join(spans, "node")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                (_, words), = word_slices(batch.column(1).slice(i, 1))
                own = [(s["lo"], s["hi"]) for s in batch.column(2)[i].as_py()]
                keep_word = uncovered(len(words.starts), own + twins(words, window, name), window)
                out.append((batch.column(0)[i].as_py(), int((~keep_word).sum()),
                            words.digests(keep_word)[0]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[k] for o in out], kind) for k, kind in enumerate(
                    (pa.binary(), pa.int64(), pa.string()))], names=["node", "gone", "left"])

    results = held.select("node", "t", "spans").mapInArrow(
        cut, "node binary, gone long, left string")
    copies = (rows.filter(F.col("n_words") >= window).groupBy("node")
              .agg(F.count("*").alias("copies")).filter("copies > 1"))
    # written first, so that a text with very many copies can be split in the join below
    verdict = reliable_checkpoint(results.join(copies, "node", "full"))
    out = rows.join(verdict, "node", "left")
    copied = F.col("copies").isNotNull()
    return out.select(
        *[F.col(f"row.{quoted(c)}").alias(c) for c in kept], "n_words",
        F.when(copied, F.col("n_words")).otherwise(F.coalesce("gone", F.lit(0)))
        .cast("long").alias("n_removed"),
        F.when(copied, F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.coalesce("left", "whole"))
        .alias("kept_sha256"))


def op12_repeated_passages(spark, sf_dir: str) -> DataFrame:
    """Every document without the words of 35-word windows that start elsewhere too."""
    return remove_passages(table(spark, sf_dir, "documents"), keep=["doc_id"])
