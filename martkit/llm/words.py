"""Words of many texts at once, and texts put together again from kept words.

A word is a maximal run of bytes other than space and 0x09-0x0D. Positions are
counted over all texts of a batch; ``first`` says where each text begins.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from .common import POWERS, mix64, raw_bytes, text_slices, word_spans


@dataclass(frozen=True)
class Words:
    """The words of some texts: byte spans in ``data``; ``first`` has n + 1 entries."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def doc(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def ids(self) -> np.ndarray:
        """A number for each word, equal exactly for equal words."""
        sizes = self.ends - self.starts
        solid = np.zeros(len(self.data) + 1, dtype=np.int8)
        solid[self.starts] += 1
        solid[self.ends] -= 1
        body = self.data[np.cumsum(solid[:-1], dtype=np.int8).astype(bool)]
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        column = pa.Array.from_buffers(pa.large_binary(), len(sizes), [
            None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(body.tobytes())])
        return column.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)

    def joined(self, keep: np.ndarray) -> list[memoryview]:
        """For each text the kept words, joined by one space."""
        at = np.flatnonzero(keep)
        n = len(self.first) - 1
        if not len(at):
            return [memoryview(b"")] * n
        doc = self.doc[at]
        tail = np.ones(len(at), dtype=np.int64)  # the space after the word, but for the last one
        tail[np.append(doc[1:] != doc[:-1], True)] = 0
        stop = self.ends[at] + tail
        mark = np.zeros(len(self.data) + 2, dtype=np.int8)
        mark[self.starts[at]] += 1
        mark[stop] -= 1
        data = self.data.copy()
        data[self.ends[at][tail == 1]] = 0x20
        out = data[np.cumsum(mark[:len(data)], dtype=np.int8).astype(bool)]
        sizes = np.bincount(doc, weights=stop - self.starts[at], minlength=n).astype(np.int64)
        edges = np.concatenate([[0], np.cumsum(sizes)])
        whole = memoryview(out.tobytes())
        return [whole[a:b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]

    def digests(self, keep: np.ndarray) -> list[str]:
        """SHA-256 (lowercase hex) of each text's kept words, joined by one space."""
        return [hashlib.sha256(x).hexdigest() for x in self.joined(keep)]


class WordSums:
    """Equality of stretches of words by prefix sums of id·base^place."""

    def __init__(self, ids: np.ndarray):
        self.up, self.down = POWERS.get(len(ids) + 1)
        x = mix64(ids.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
        self.sums = np.zeros(len(ids) + 1, dtype=np.uint64)
        np.cumsum(x * self.up[:len(ids)], out=self.sums[1:])

    def equal(self, at: np.ndarray, period: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Whether n words from ``at`` equal those one period later."""
        s = self.sums
        return (s[at + n] - s[at]) * self.up[period] == s[at + period + n] - s[at + period]

    def spans(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Hashes of the stretches [lo, hi), wherever they stand."""
        return mix64((self.sums[hi] - self.sums[lo]) * self.down[lo])

    def reach(self, at: np.ndarray, period: np.ndarray, most: np.ndarray, back: bool) -> np.ndarray:
        """How many words on from ``at`` (or back, before it) equal those one period later."""
        low, high = np.zeros(len(at), dtype=np.int64), most.copy()
        while (open_ := low < high).any():
            mid = np.where(open_, (low + high + 1) // 2, low)
            ok = self.equal(at - mid if back else at, period, mid)
            low = np.where(ok, mid, low)
            high = np.where(ok, high, mid - 1)
        return low


def word_slices(texts: pa.Array, limit: int = 1 << 19):
    """(first row, ``Words``) of parts of a string array of about ``limit`` bytes each."""
    data, offsets = raw_bytes(texts)
    for lo, hi in text_slices(offsets, limit):
        part, edges = data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        starts, ends = word_spans(part, edges)
        yield lo, Words(part, starts, ends, np.searchsorted(starts, edges))
