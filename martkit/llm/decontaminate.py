"""Benchmark decontamination by template canonicalisation.

Texts become sequences of canonical words: numbers, units that follow a number
and names (capitalised words inside a sentence that is not all capitals; a run
of them is one name) are replaced with typed placeholders, all others
lower-cased. Windows of canonical words are joined by hash between documents and
benchmark items, and so are literal windows, of the lower-cased words as they
stand: they find what has too few words besides its values. Windows of one
document and item on one diagonal (same offset) make runs; runs that follow each
other in order, no further apart than the item is long, are one alignment, so
words may be put in or left out. Its slots
bind the item's values to the document's. A binding must be one to one over
the alignment; windows that use another binding are dropped. What is left must
cover enough of the item. So a question with other numbers or names is caught,
if each of its values was replaced in the same way everywhere.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.cache import reliable_checkpoint
from .common import (add_columns, lower_bytes, others, prefix_hash, quoted, raw_bytes, span_hash,
                     table, text_key, text_of, text_slices, window_hash)

WIDTH = 8             # canonical words in a window
MIN_LITERAL = 5       # words of a template window that must not be placeholders
MIN_COVER = 0.5       # share of an item's words that its windows must cover
INDEX_WORDS = 1 << 19  # benchmark words indexed at a time (some 100 MB a worker); more take several passes

# Unit words that are slots when they follow a number.
UNITS = ("kg g mg t lb oz km m cm mm mi ft yd inch inches l ml cl s ms sec second seconds min "
         "minute minutes h hour hours day days week weeks month months year years mph kmh w kw v "
         "a hz khz mhz ghz b kb mb gb tb usd eur gbp dollar dollars euro euros cent cents percent "
         "c f k meter meters metre metres kilometer kilometers mile miles gram grams kilogram "
         "kilograms liter liters litre litres").split()

NUM, UNIT, NAME = 1, 2, 3
_TAGS = np.array([0, 0x9AE16A3B2F90404F, 0xC949D7C7509E6557, 0xFF51AFD7ED558CCD], dtype=np.uint64)

_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[48:58] = True
_WORD = np.zeros(256, dtype=bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True
_JOIN = np.zeros(256, dtype=bool)
_JOIN[[44, 46]] = True           # , and . inside a number
_STOP = np.zeros(256, dtype=bool)
_STOP[[10, 33, 46, 58, 63, 124]] = True  # behind these a sentence begins


@dataclass
class Canonical:
    """Canonical words of a batch of texts: hash, slot type, slot value, text number.

    ``words`` are the hashes of the lower-cased words as they stand, with their
    text numbers; canonical word i is made of the words from ``first[i]`` up to
    ``first[i + 1]``.
    """

    tokens: np.ndarray
    kinds: np.ndarray
    values: np.ndarray
    rows: np.ndarray
    words: np.ndarray
    word_rows: np.ndarray
    first: np.ndarray


def _nothing() -> Canonical:
    zero, none = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return Canonical(zero, np.zeros(0, np.int8), zero, none, zero, none, np.zeros(1, np.int64))


def canonical(data: np.ndarray, offsets: np.ndarray, units: np.ndarray) -> Canonical:
    """Vectorised canonicalisation of back-to-back texts (``units``: sorted unit hashes)."""
    n = len(data)
    if not n:
        return _nothing()
    cut = np.zeros(n + 1, dtype=bool)
    cut[offsets] = True
    digit = _DIGIT[data]
    solid = _WORD[data]
    inner = np.zeros(n, dtype=bool)
    inner[1:-1] = _JOIN[data[1:-1]] & digit[:-2] & digit[2:] & ~cut[1:n - 1] & ~cut[2:n]
    solid |= inner
    before = np.zeros(n, dtype=bool)
    before[1:] = solid[:-1]
    starts = np.flatnonzero(solid & (~before | cut[:n]))
    after = np.zeros(n, dtype=bool)
    after[:-1] = solid[1:]
    ends = np.flatnonzero(solid & (~after | cut[1:])) + 1
    if not len(starts):
        return _nothing()
    rows = np.searchsorted(offsets, starts, side="right") - 1
    hashes = span_hash(prefix_hash(lower_bytes(data)), starts, ends)
    numeric = np.concatenate([[0], np.cumsum(digit | inner)])
    kinds = np.zeros(len(starts), dtype=np.int8)
    kinds[numeric[ends] - numeric[starts] == ends - starts] = NUM
    first = data[starts]
    second = data[np.minimum(starts + 1, n - 1)]
    capital = ((first >= 65) & (first <= 90)) | ((first == 0xC3) & (second >= 0x80) & (second <= 0x9E))
    stops = np.concatenate([[0], np.cumsum(_STOP[data])])
    gap = np.concatenate([[0], ends[:-1]])
    opening = np.concatenate([[True], rows[1:] != rows[:-1]])
    opening |= stops[starts] - stops[gap] > 0  # a sentence end lies between the words
    # a sentence without any other letter than capitals has no names
    other = (data >= 97) & (data <= 122) | (data >= 128)
    big = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E))
    other[big] = other[big + 1] = False
    small = np.concatenate([[0], np.cumsum(other)])
    sentence = np.cumsum(opening) - 1
    mixed = np.bincount(sentence, weights=small[ends] - small[starts]) > 0
    kinds[capital & ~opening & mixed[sentence]] = NAME
    follows = np.concatenate([[False], (kinds[:-1] == NUM) & (rows[1:] == rows[:-1])])
    if len(units):
        at = np.minimum(np.searchsorted(units, hashes), len(units) - 1)
        kinds[(units[at] == hashes) & follows] = UNIT
    # a run of names is one name: its value is the hash of its words in order
    name = kinds == NAME
    again = np.concatenate([[False], name[1:] & name[:-1] & (rows[1:] == rows[:-1])])
    values = hashes.copy()
    for i in np.flatnonzero(again):
        values[i] = values[i - 1] * np.uint64(0xC2B2AE3D27D4EB4F) + hashes[i]
    last = np.ones(len(starts), dtype=bool)
    last[:-1] = ~again[1:]
    tokens = np.where(kinds > 0, _TAGS[kinds], hashes)[last]
    return Canonical(tokens, kinds[last], values[last], rows[last], hashes, rows,
                     np.append(np.flatnonzero(~again), len(starts)))


def unit_hashes() -> np.ndarray:
    data, offsets = raw_bytes(pa.array(UNITS))
    return np.sort(span_hash(prefix_hash(data), offsets[:-1], offsets[1:]))


def windows(c: Canonical, width: int, min_literal: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the windows inside one text with enough literal words."""
    h = window_hash(c.tokens, width)
    if not len(h):
        return np.zeros(0, np.int64), h
    literal = np.concatenate([[0], np.cumsum(c.kinds == 0)])
    ok = (literal[width:] - literal[:-width]) >= min(min_literal, width)
    ok &= c.rows[width - 1:] == c.rows[:len(h)]
    at = np.flatnonzero(ok)
    return at, h[at]


def literal_windows(c: Canonical, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of all windows of words as they stand inside one text."""
    h = window_hash(c.words, width)
    at = np.flatnonzero(c.word_rows[width - 1:] == c.word_rows[:len(h)]) if len(h) else (
        np.zeros(0, np.int64))
    return at, h[at]


class Table:
    """Windows of one width by hash: item and place of each, behind a filter of the hashes."""

    def __init__(self, rows: list[tuple[int, int, int]]) -> None:
        rows.sort()
        self.keys = np.array([r[0] for r in rows], dtype=np.uint64)
        self.items = np.array([r[1] for r in rows])
        self.places = np.array([r[2] for r in rows])
        self.seen = np.zeros(1 << 22, dtype=bool)
        self.seen[(self.keys >> np.uint64(42)).astype(np.int64)] = True

    def find(self, at: np.ndarray, h: np.ndarray):
        """(position, item, place) of every window that is held here."""
        near = self.seen[(h >> np.uint64(42)).astype(np.int64)]
        at, h = at[near], h[near]
        lo = np.searchsorted(self.keys, h, side="left")
        hi = np.searchsorted(self.keys, h, side="right")
        for p, a, b in zip(at.tolist(), lo.tolist(), hi.tolist()):
            for k in range(a, b):
                yield p, int(self.items[k]), int(self.places[k])


@dataclass
class Run:
    """Windows that follow each other on one diagonal; bounds in words as they stand."""

    p: int
    q: int
    p1: int
    q1: int
    found: list[tuple[int, int, int]]
    literal: list[tuple[int, int, int]]


class Index:
    """Hash index of the items' template and literal windows, with each item's canonical words.

    An item shorter than the window is indexed by one window of its own length.
    """

    def __init__(self, items: Sequence[tuple[str, str]], width: int, min_literal: int) -> None:
        self.width, self.min_literal = width, min_literal
        self.units = unit_hashes()
        self.names = [i for i, _ in items]
        data, offsets = raw_bytes(pa.array([t for _, t in items], pa.string()))
        c = canonical(data, offsets, self.units)
        lo = np.searchsorted(c.rows, np.arange(len(items)), side="left")
        hi = np.searchsorted(c.rows, np.arange(len(items)), side="right")
        self.kinds = [c.kinds[a:b] for a, b in zip(lo, hi)]
        self.values = [c.values[a:b] for a, b in zip(lo, hi)]
        self.first = [c.first[a:b + 1] - c.first[a] for a, b in zip(lo, hi)]
        found = defaultdict(list)  # width -> [(hash, item, place)]
        at, h = windows(c, width, min_literal)
        for p, x in zip(at.tolist(), h.tolist()):
            item = int(c.rows[p])
            found[width].append((x, item, p - int(lo[item])))
        literal = defaultdict(list)
        at, h = literal_windows(c, width)
        for p, x in zip(at.tolist(), h.tolist()):
            item = int(c.word_rows[p])
            literal[width].append((x, item, p - int(c.first[lo[item]])))
        for item, (a, b) in enumerate(zip(lo.tolist(), hi.tolist())):
            own = b - a
            if min_literal <= own < width and (c.kinds[a:b] == 0).sum() >= min_literal:
                found[own].append((int(window_hash(c.tokens[a:b], own)[0]), item, 0))
            words = c.words[c.first[a]:c.first[b]]
            if min_literal <= len(words) < width:
                literal[len(words)].append((int(window_hash(words, len(words))[0]), item, 0))
        self.tables = {w: Table(rows) for w, rows in found.items()}
        self.literal = {w: Table(rows) for w, rows in literal.items()}

    def hits(self, c: Canonical):
        """(text, word, item, item word, width) of every template window that text and item share."""
        for w, table in self.tables.items():
            for p, item, q in table.find(*windows(c, w, self.min_literal)):
                yield int(c.rows[p]), p, item, q, w

    def literal_hits(self, c: Canonical):
        """The same of every literal window, counted in words as they stand."""
        for w, table in self.literal.items():
            for p, item, q in table.find(*literal_windows(c, w)):
                yield int(c.word_rows[p]), p, item, q, w

    def judge(self, c: Canonical, item: int, shift: int, found: list[tuple[int, int, int]],
              literal: Sequence[tuple[int, int, int]] = ()):
        """:meth:`judge_chain` of the windows on the diagonal ``shift``."""
        return self.judge_chain(c, item, [x for x in found if x[0] - x[1] == shift], literal)

    def judge_chain(self, c: Canonical, item: int, found: Sequence[tuple[int, int, int]],
                    literal: Sequence[tuple[int, int, int]] = (), twice: int = 0):
        """(coverage, windows, changed slots) of one alignment after the slot check.

        ``found`` and ``literal`` hold (word, item word, width) of its template
        and literal windows. Literal windows change nothing and need no check.
        ``twice`` item words are taken off: their document words are used twice.
        """
        kinds, values, first = self.kinds[item], self.values[item], self.first[item]
        slots = sorted({(q + k, p + k) for p, q, w in found for k in range(w) if kinds[q + k]})
        there = {(s, d): (int(kinds[s]), int(values[s]), int(c.values[d])) for s, d in slots}
        votes = Counter(there.values())
        bound, taken = {}, set()
        for (kind, a, b), _ in sorted(votes.items(), key=lambda x: (-x[1], x[0])):
            if (kind, a) not in bound and (kind, b) not in taken:
                bound[kind, a] = b
                taken.add((kind, b))
        words, kept = np.zeros(first[-1], dtype=np.int64), set()
        for p, q, w in found:
            if all(bound.get(there[q + k, p + k][:2]) == there[q + k, p + k][2]
                   for k in range(w) if kinds[q + k]):
                words[first[q]:first[q + w]] = 1
                kept.add((int(c.first[p]), int(first[q])))
        for p, q, w in literal:
            words[q:q + w] = 1
            kept.add((p, q))
        whole = np.minimum.reduceat(words, first[:-1]) if len(kinds) else words[:0]
        changed = sum(a != b for (k, a, b) in there.values() if bound.get((k, a)) == b)
        return max(0.0, float((whole.sum() - twice) / max(1, len(kinds)))), len(kept), changed

    def runs(self, c: Canonical, item: int, found: list[tuple[int, int, int]], exact: bool):
        """The windows of one diagonal cut where they neither overlap nor touch."""
        found.sort(key=lambda x: (x[1], x[2]))
        first, out, end = self.first[item], [], -1
        for x in found:
            if x[1] > end:
                out.append([])
            out[-1].append(x)
            end = max(end, x[1] + x[2])
        for part in out:
            p, q = part[0][:2]
            p1, q1 = max(x[0] + x[2] for x in part), max(x[1] + x[2] for x in part)
            if exact:
                yield Run(p, q, p1, q1, [], part)
            else:
                yield Run(int(c.first[p]), int(first[q]), int(c.first[p1]), int(first[q1]), part, [])

    def alignments(self, item: int, runs: list[Run]):
        """(template windows, literal windows, words used twice) of each chain of runs.

        In a chain both the starts and the ends grow in the document and in the
        item. Of the chains that end with a run, the one that covers most of the
        item is taken, then the densest; chains that are part of another are left
        out. Runs that lie inside one of a chain, on its diagonal, belong to it.
        """
        runs.sort(key=lambda r: (r.p, r.q, r.p1, r.q1))
        near = int(self.first[item][-1])
        reach = near + max(r.p1 - r.p for r in runs)
        best, inner = [], set()
        for j, b in enumerate(runs):
            top = (b.q1 - b.q, 0, -1, 0)
            for i in range(j - 1, -1, -1):
                a = runs[i]
                if b.p - a.p > reach:
                    break
                if not (a.p < b.p and a.q < b.q and a.p1 < b.p1 and a.q1 < b.q1
                        and b.p - a.p1 <= near):
                    continue
                again = max(0, a.p1 - b.p - max(0, a.q1 - b.q))
                new = b.q1 - max(b.q, a.q1) - again
                if new > 0:
                    gap = max(0, b.p - a.p1)
                    top = max(top, (best[i][0] + new, best[i][1] - gap, i, best[i][3] + again))
            best.append(top)
            inner.add(top[2])
        for j in range(len(runs)):
            if j in inner:
                continue
            chain, k = [], j
            while k >= 0:
                chain.append(runs[k])
                k = best[k][2]
            lo, hi = chain[-1].p, chain[0].p1
            whole = chain + [r for r in runs if lo <= r.p and r.p1 <= hi and any(
                r is not m and m.p <= r.p and r.p1 <= m.p1 and r.p - r.q == m.p - m.q
                and m.q1 >= r.q1 for m in chain)]
            yield (sorted({x for r in whole for x in r.found}),
                   sorted({x for r in whole for x in r.literal}), best[j][3])


LEAK = "struct<item:string,coverage:double,windows:long,changed_slots:long>"


def _leaks(items: Sequence[tuple[str, str]], width: int, min_literal: int, min_cover: float):
    kind = pa.list_(pa.struct([("item", pa.string()), ("coverage", pa.float64()),
                               ("windows", pa.int64()), ("changed_slots", pa.int64())]))

    def make():
        index = Index(items, width, min_literal)

        def work(texts: pa.Array):
            out: list[list[dict]] = [[] for _ in range(len(texts))]
            data, offsets = raw_bytes(texts)
            for lo, hi in text_slices(offsets):
                c = canonical(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo],
                              index.units)
                aligned = defaultdict(list)
                for row, p, item, q, w in index.hits(c):
                    aligned[row, item, p - q, False].append((p, q, w))
                for row, p, item, q, w in index.literal_hits(c):
                    aligned[row, item, p - q, True].append((p, q, w))
                best: dict[tuple[int, int], tuple] = {}
                runs = defaultdict(list)
                for (row, item, shift, exact), found in aligned.items():
                    best[row, item] = max(
                        best.get((row, item), (0.0, 0, 0)),
                        index.judge(c, item, shift, *(([], found) if exact else (found, []))))
                    runs[row, item] += index.runs(c, item, found, exact)
                for (row, item), parts in runs.items():
                    for found, literal, twice in index.alignments(item, parts):
                        best[row, item] = max(
                            best[row, item], index.judge_chain(c, item, found, literal, twice))
                for (row, item), (cover, kept, changed) in sorted(best.items()):
                    if cover >= min_cover:
                        out[lo + row].append({"item": index.names[item], "coverage": cover,
                                              "windows": kept, "changed_slots": changed})
            return [pa.array(out, kind)]

        return work

    return make


def find_leaks(df: DataFrame, benchmark: DataFrame, text: str = "text", *,
               item_id: str = "item_id", item_text: str = "text", width: int = WIDTH,
               min_literal: int = MIN_LITERAL, min_cover: float = MIN_COVER,
               index_words: int = INDEX_WORDS, keep: Sequence[str] | None = None) -> DataFrame:
    """Append ``leaks``: the benchmark items that each whole text contains.

    Null and empty texts and items match nothing, nor do items of less than
    ``min_literal`` words; items without that many literal words are found with
    their own values only. A null item id is reported as null. Repeated
    items are reported as often as they stand in the benchmark. The benchmark's
    size is checked first: up to about ``index_words`` words of it, and so windows,
    are indexed and sent to the tasks at a time; a larger one takes several passes
    over the documents, each written to the checkpoint folder, with the same result.
    """
    items = benchmark.select(F.col(quoted(item_id)).cast("string").alias("i"),
                             text_of(item_text).alias("t"))
    words = F.size(F.split("t", r"[\x20\x09-\x0D]+")) + F.size(F.split("t", r"[^\w\s]"))
    size = items.agg(F.sum(words)).first()[0] or 0
    passes = -(-size // index_words) or 1
    part = F.pmod(F.xxhash64("i", "t"), F.lit(passes))

    def read(k: int) -> list[tuple[str, str]]:
        rows = items if passes == 1 else items.filter(part == k)
        return sorted(((r["i"], r["t"]) for r in rows.collect()), key=lambda r: (r[0] or "", r[1]))

    if passes == 1:
        return add_columns(df, text, f"leaks array<{LEAK}>",
                           _leaks(read(0), width, min_literal, min_cover), keep)
    keyed = df.select(text_of(text).alias("t")).withColumn("__llm_key", text_key(F.col("t")))
    found = []
    for k in range(passes):
        hit = add_columns(keyed, "t", f"leaks array<{LEAK}>",
                          _leaks(read(k), width, min_literal, min_cover), ["__llm_key"])
        found.append(reliable_checkpoint(hit.filter(F.size("leaks") > 0).distinct()))
    union = found[0]
    for f in found[1:]:
        union = union.unionByName(f)
    merged = union.groupBy("__llm_key").agg(
        F.array_sort(F.flatten(F.collect_list("leaks"))).alias("leaks"))
    kept = [c for c in (df.columns if keep is None else keep) if c in others(df, "leaks")]
    rows = df.select(*[F.col(quoted(c)) for c in kept], text_key(text_of(text)).alias("__llm_key"))
    return rows.join(merged, "__llm_key", "left").select(
        *[F.col(quoted(c)) for c in kept],
        F.coalesce("leaks", F.array().cast(f"array<{LEAK}>")).alias("leaks"))


def op7_decontaminate(spark, sf_dir: str) -> DataFrame:
    """One row per document and benchmark item that it contains."""
    found = find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"),
                       keep=["doc_id"])
    return (found.select("doc_id", F.explode("leaks").alias("leak"))
            .select("doc_id", F.col("leak.item").cast("long").alias("item_id"),
                    F.round("leak.coverage", 6).alias("coverage"),
                    F.col("leak.windows").alias("n_windows"),
                    F.col("leak.changed_slots").alias("changed_slots")))
