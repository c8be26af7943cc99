"""Periodic runs of words by grammar compression.

The word ids of each text are compressed by Re-Pair: pairs of neighbouring
symbols that stand at least twice become nonterminals, the most frequent first,
until no pair repeats; the symbols that are left are joined by a balanced tree.
Every stretch of words then lies in a lowest symbol X -> A B of the derivation
and crosses the boundary between A and B there, so

* runs are looked for only around the boundary of each symbol, once, however
  often the symbol stands in the text. A run of at least four periods has two of
  them on one side of the boundary: a square that ends or starts there shows it;
* what is found in a symbol is translated to all places where the symbol is
  derived, and pieces of one run (same period, overlapping by a period or more)
  are merged to the maximal one.

Many texts are handled together in NumPy. In each round all pairs that rank
above both pairs they overlap are replaced, so a text's most frequent pair is
always replaced whole and rounds grow with the logarithm of what repeats.
Squares are compared by hashes of word ids; every run is then checked word by
word, and a text in which that check fails is scanned without hashes.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from functools import cmp_to_key

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_columns, mix64, others, quoted, table, text_of
from .words import WordSums, word_slices

PERIODS = 4       # least exponent of a run
LEAST = 6         # least words of a run
TESTS = 1 << 20   # squares tested at a time (bounds a task's memory)

OUTPUTS = ("n_runs long, start long, length long, period long, exponent_milli long, "
           "runs_sha256 string, collapsed_sha256 string")
RUNS = "runs array<struct<start: long, length: long, period: long>>"


class Grammar:
    """The symbols of a batch of texts: children, length and one place of each.

    Symbols below ``words`` are words. ``rounds`` has the first symbol made in
    each round, so children always belong to earlier rounds; ``roots`` has the
    symbol of each text that has words.
    """

    def __init__(self, ids: np.ndarray, first: np.ndarray):
        doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
        # a word of each text is a symbol of its own: texts do not share their grammars
        low = ids + doc * (int(ids.max()) + 1 if len(ids) else 1)
        sym = _codes(low)[0]
        self.words = int(sym.max()) + 1 if len(sym) else 0
        empty = np.zeros(self.words, dtype=np.int64)
        where = np.zeros(self.words, dtype=np.int64)
        where[sym[::-1]] = np.arange(len(sym))[::-1]
        self._parts = [(empty, empty, np.ones(self.words, dtype=np.int64), where)]
        self.rounds = [0, self.words]
        rest = self._pairs(sym, doc, np.arange(len(sym)))
        self._tree(*rest)
        self.left, self.right, self.length, self.place = (
            np.concatenate(x) for x in zip(*self._parts))

    def _add(self, left, right, length, place) -> np.ndarray:
        """The numbers of new symbols."""
        lo = self.rounds[-1]
        self._parts.append((left, right, length, place))
        self.rounds.append(lo + len(left))
        return np.arange(lo, lo + len(left))

    def _pairs(self, sym: np.ndarray, doc: np.ndarray, at: np.ndarray):
        """Re-Pair; returns (symbols, texts, places) that are left, in order."""
        size = np.ones(len(sym), dtype=np.int64)
        done = []
        while len(sym) > 1:
            same = doc[1:] == doc[:-1]
            twin = same & (sym[1:] == sym[:-1])
            if twin.any():  # of a stretch of equal symbols every other pair counts
                n = np.arange(len(twin))
                begin = np.maximum.accumulate(np.where(
                    twin & ~np.concatenate([[False], twin[:-1]]), n, 0))
                same &= ~(twin & ((n - begin) % 2 == 1))
            here = np.flatnonzero(same)
            code, keys = _codes((sym[here] << 32) | sym[here + 1])
            count = np.bincount(code, minlength=len(keys))
            often = np.flatnonzero(count > 1)
            if not len(often):
                break
            rank = np.zeros(len(keys), dtype=np.int64)
            ties = mix64(keys[often].astype(np.uint64))
            rank[often[np.lexsort((ties, count[often]))]] = np.arange(1, len(often) + 1)
            weight = np.zeros(len(sym) + 1, dtype=np.int64)  # one empty place at each end
            weight[here + 1] = rank[code]
            mid = weight[1:-1]
            best = (mid > 0) & (mid > weight[:-2]) & (mid > weight[2:])
            of = np.full(len(sym), -1, dtype=np.int64)
            of[here] = code
            top = np.flatnonzero(best)
            used = np.bincount(of[top], minlength=len(keys)) > 1
            top = top[used[of[top]]]
            if not len(top):
                break
            fresh, back = np.unique(of[top], return_inverse=True)
            one = np.zeros(len(fresh), dtype=np.int64)
            one[back[::-1]] = top[::-1]
            new = self._add(sym[one], sym[one + 1], size[one] + size[one + 1], at[one])
            size[top] += size[top + 1]
            sym = sym.copy()
            sym[top] = new[back]
            stay = np.ones(len(sym), dtype=bool)
            stay[top + 1] = False
            active = np.zeros(int(doc[-1]) + 1, dtype=bool)
            active[doc[top]] = True
            live = active[doc]
            over = stay & ~live
            done.append((sym[over], doc[over], at[over], size[over]))
            stay &= live
            sym, doc, at, size = sym[stay], doc[stay], at[stay], size[stay]
        done.append((sym, doc, at, size))
        sym, doc, at, size = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(at, kind="stable")
        return sym[order], doc[order], at[order], size[order]

    def _tree(self, sym, doc, at, size) -> None:
        """A balanced tree over the symbols that are left of each text."""
        while True:
            begin = np.ones(len(sym), dtype=bool)
            begin[1:] = doc[1:] != doc[:-1]
            n = np.arange(len(sym))
            step = n - np.maximum.accumulate(np.where(begin, n, 0))
            top = np.flatnonzero((step[:-1] % 2 == 0) & ~begin[1:]) if len(sym) else step
            if not len(top):
                self.roots = sym
                return
            new = self._add(sym[top], sym[top + 1], size[top] + size[top + 1], at[top])
            sym, size = sym.copy(), size.copy()
            sym[top] = new
            size[top] += size[top + 1]
            stay = np.ones(len(sym), dtype=bool)
            stay[top + 1] = False
            sym, doc, at, size = sym[stay], doc[stay], at[stay], size[stay]

    def derived(self, marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(symbol, place) of every place where a marked symbol is derived."""
        leads = marked.copy()
        for lo, hi in zip(self.rounds[1:-1], self.rounds[2:]):
            leads[lo:hi] |= leads[self.left[lo:hi]] | leads[self.right[lo:hi]]
        sym = self.roots[leads[self.roots]]
        at = self.place[sym]
        out = []
        while len(sym):
            hit = marked[sym]
            out.append((sym[hit], at[hit]))
            inner = sym >= self.words
            sym, at = sym[inner], at[inner]
            below = np.concatenate([self.left[sym], self.right[sym]])
            at = np.concatenate([at, at + self.length[self.left[sym]]])
            on = leads[below]
            sym, at = below[on], at[on]
        if not out:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return tuple(np.concatenate(x) for x in zip(*out))


def _codes(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers from 0 for equal values, and the values."""
    coded = pa.array(values.astype(np.int64, copy=False)).dictionary_encode()
    return (coded.indices.to_numpy(zero_copy_only=False).astype(np.int64),
            coded.dictionary.to_numpy(zero_copy_only=False))


def _squares(ids: np.ndarray, h: WordSums, g: Grammar, after: bool, nodes: np.ndarray):
    """(symbol, period, place) of squares that start (or else end) at the symbols' boundaries."""
    lo = g.place[nodes]
    b = lo + g.length[g.left[nodes]]
    room = (lo + g.length[nodes] - b if after else b - lo) // 2
    most = np.minimum(g.length[nodes] // PERIODS, room)
    total = np.concatenate([[0], np.cumsum(most)])
    i = 0
    while i < len(nodes):
        j = max(i + 1, int(np.searchsorted(total, total[i] + TESTS, side="right")) - 1)
        own = np.repeat(np.arange(i, j), most[i:j])
        q = np.arange(len(own)) - (total[own] - total[i]) + 1
        at = b[own] if after else b[own] - q  # the second half's place, or the first word of it
        like = ids[at + q] == ids[at] if after else ids[b[own] - 1] == ids[b[own] - 1 - q]
        own, q, at = own[like], q[like], at[like]
        at = at if after else at - q
        ok = h.equal(at, q, q)
        yield nodes[own[ok]], q[ok], at[ok]
        i = j


def _crossing(ids: np.ndarray, g: Grammar):
    """(symbol, start, end, period): maximal inside the symbol, places relative to it."""
    h = WordSums(ids)
    nodes = np.flatnonzero(g.length >= LEAST)
    found = [x for after in (True, False) for x in _squares(ids, h, g, after, nodes)]
    if not found:
        return (np.zeros(0, np.int64),) * 4
    node, q, at = (np.concatenate(x) for x in zip(*found))
    lo, hi = g.place[node], g.place[node] + g.length[node]
    s = at - h.reach(at, q, at - lo, back=True)
    e = at + 2 * q + h.reach(at + q, q, hi - at - 2 * q, back=False)
    ok = e - s >= np.maximum(LEAST, PERIODS * q)
    node, s, e, q = node[ok], (s - lo)[ok], (e - lo)[ok], q[ok]
    return _first_of((node, s, e), q)


def _first_of(keys: Sequence[np.ndarray], q: np.ndarray):
    """One row for equal keys, with the smallest period."""
    order = np.lexsort((q, *reversed(keys)))
    new = np.ones(len(order), dtype=bool)
    new[1:] = np.any([k[order[1:]] != k[order[:-1]] for k in keys], axis=0) if len(order) else []
    at = order[new]
    return (*(k[at] for k in keys), q[at])


def find_runs(ids: np.ndarray, first: np.ndarray):
    """(text, start, end, period) of all runs of the texts; places count in ``ids``.

    ``ids`` has the texts' word ids back to back, ``first`` where each begins.
    Sorted by text, start and period.
    """
    g = Grammar(ids, first)
    node, s, e, q = _crossing(ids, g)
    if not len(node):
        return (np.zeros(0, np.int64),) * 4
    marked = np.zeros(len(g.length), dtype=bool)
    marked[node] = True
    sym, at = g.derived(marked)
    lo = np.searchsorted(node, sym)
    n = np.searchsorted(node, sym, side="right") - lo
    row = np.repeat(np.arange(len(sym)), n)
    piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + lo[row]
    s, e, q = s[piece] + at[row], e[piece] + at[row], q[piece]
    doc = np.searchsorted(first, s, side="right") - 1
    # merge: pieces of one run share its period and lie in each other or overlap by a period
    order = np.lexsort((s, q, doc))
    doc, s, e, q = doc[order], s[order], e[order], q[order]
    group = np.zeros(len(s), dtype=np.int64)
    group[1:] = np.cumsum((doc[1:] != doc[:-1]) | (q[1:] != q[:-1]))
    wide = group * (len(ids) + 1)
    ends = np.maximum.accumulate(e + wide)
    new = np.ones(len(s), dtype=bool)
    new[1:] = s[1:] + q[1:] + wide[1:] > ends[:-1]
    begin = np.flatnonzero(new)
    doc, s, e, q = doc[begin], s[begin], np.maximum.reduceat(e, begin), q[begin]
    doc, s, e, q = _first_of((doc, s, e), q)
    wrong = set()
    for d, a, z, p in zip(doc.tolist(), s.tolist(), e.tolist(), q.tolist()):
        lo, hi = first[d], first[d + 1]
        if not (np.array_equal(ids[a:z - p], ids[a + p:z])
                and (a == lo or ids[a - 1] != ids[a - 1 + p])
                and (z == hi or ids[z] != ids[z - p])):
            wrong.add(d)
    out = list(zip(doc.tolist(), s.tolist(), e.tolist(), q.tolist()))
    if wrong:  # two stretches with one hash: look at the text itself
        out = [r for r in out if r[0] not in wrong]
        for d in wrong:
            lo = int(first[d])
            out += [(d, a + lo, z + lo, p) for a, z, p in scan_runs(ids[lo:first[d + 1]])]
    out.sort(key=lambda r: (r[0], r[1], r[3]))
    return tuple(np.array([r[k] for r in out], dtype=np.int64) for k in range(4))


def scan_runs(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, end, period) of the runs of one text, by comparing it with itself at every shift."""
    best: dict[tuple[int, int], int] = {}
    for q in range(1, len(ids) // PERIODS + 1):
        stops = np.flatnonzero(np.append(ids[:-q] != ids[q:], True))
        begin = np.concatenate([[0], stops[:-1] + 1])
        for a, z in zip(begin.tolist(), (stops + q).tolist()):
            if z - a >= max(LEAST, PERIODS * q):
                best.setdefault((a, z), q)
    return sorted((a, z, q) for (a, z), q in best.items())


def _largest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run (start, length, period) of greatest exponent; then least start, then period."""
    def order(a, b) -> int:
        return b[1] * a[2] - a[1] * b[2] or a[0] - b[0] or a[2] - b[2]

    return min(runs, key=cmp_to_key(order)) if runs else None


def periodic_runs(df: DataFrame, text: str = "text", *, keep: Sequence[str] | None = None,
                  spans: bool = True) -> DataFrame:
    """Append the text's runs: count, the one of greatest exponent, digests and ``runs``.

    A run is a stretch of words with smallest period q, at least 6 words and 4
    periods long, that no neighbouring word continues. ``collapsed_sha256`` is the
    digest of the words that are in no run or among its first q words, joined by
    one space; ``runs_sha256`` that of the lines ``start,length,period``. Null and
    empty texts have no words: no runs, four nulls, digests of nothing. Equal texts
    have equal results, rows never share a grammar. A text is handled whole in one
    task, in memory proportional to it. Clashing input columns are replaced.
    """
    def make():
        def work(texts: pa.Array) -> list[pa.Array]:
            rows: list[tuple] = []
            for _, words in word_slices(texts):
                ids = words.ids()
                doc, s, e, q = find_runs(ids, words.first)
                keep_word = np.ones(len(ids), dtype=bool)
                of: dict[int, list[tuple[int, int, int]]] = {}
                for d, a, z, p in zip(doc.tolist(), s.tolist(), e.tolist(), q.tolist()):
                    keep_word[a + p:z] = False
                    of.setdefault(d, []).append((a - int(words.first[d]), z - a, p))
                for d, digest in enumerate(words.digests(keep_word)):
                    runs = of.get(d, [])
                    lines = "".join(f"{a},{n},{p}\n" for a, n, p in runs)
                    big = _largest(runs) or (None, None, None)
                    milli = 1000 * big[1] // big[2] if runs else None
                    rows.append((len(runs), *big, milli,
                                 hashlib.sha256(lines.encode()).hexdigest(), digest,
                                 [{"start": a, "length": n, "period": p} for a, n, p in runs]))
            return [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
        return work

    kinds = [pa.int64()] * 5 + [pa.string()] * 2
    if spans:
        kinds.append(pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])))
    return add_columns(df, text, f"{OUTPUTS}, {RUNS}" if spans else OUTPUTS, make, keep=keep)


def repeat_tails(df: DataFrame, text: str = "text", ident: str = "doc_id") -> DataFrame:
    """Texts of which one in ten repeats its tail, as the contract of the query asks.

    With h = crc32 of the decimal id and g = h div 10, in texts with h mod 10 = 0
    word i >= a becomes word a + (i - a) mod p, where a = g mod n and
    p = 1 + (n - a) div (3 + g mod 8). Rows without id keep their text.
    """
    kept = others(df, text)
    h = F.crc32(F.col(quoted(ident)).cast("string").cast("binary"))
    word = re.compile(rb"[^\x20\x09-\x0D]+")

    @F.arrow_udf(T.StringType())
    def tiled(texts: pa.Array, hashes: pa.Array) -> pa.Array:
        out: list[str | None] = []
        for t, x in zip(texts.to_pylist(), hashes.to_pylist()):
            if t is None:
                out.append(None)
                continue
            words = word.findall(t.encode())
            if words:
                g, n = x // 10, len(words)
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                tail = words[a:a + p]
                words[a:] = (tail * ((n - a) // p + 1))[:n - a]
            out.append(b" ".join(words).decode())
        return pa.array(out, pa.string())

    chosen = F.when(h % 10 == 0, text_of(text))  # of the others no text goes to Python here
    return df.select(*[F.col(quoted(c)) for c in kept],
                     F.coalesce(tiled(chosen, h), text_of(text)).alias(text))


def op13_periodic_runs(spark, sf_dir: str) -> DataFrame:
    """Runs of words in every document, after one in ten got a repeated tail."""
    docs = table(spark, sf_dir, "documents")
    return periodic_runs(repeat_tails(docs), keep=["doc_id"], spans=False)
