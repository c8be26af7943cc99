"""Token counts by a linear longest-match automaton.

The vocabulary is a trie with two roots: pieces that begin a word and pieces
that continue one. Every node knows its failure link (the node of the text
left over once the longest-match pieces of its string are popped) and how many
pieces are popped on the way. Reading a word byte by byte then gives the
number of greedy longest-match pieces in time linear in its length, without
building a piece and without looking back.
"""

from __future__ import annotations

import functools
from collections import deque
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import read_ranks, token_bytes
from .common import add_columns, table

CACHE_WORDS = 1 << 19  # counts remembered per task; the memory bound, not a limit on words


class LongestMatch:
    """Failure-link trie over the pieces that begin and that continue a word."""

    def __init__(self, begin: Sequence[bytes], inside: Sequence[bytes]) -> None:
        self.go: dict[int, int] = {}  # node * 256 + byte -> node
        self.is_piece = [False, False]
        parent: list[tuple[int, int]] = [(-1, 0), (-1, 0)]
        for root, pieces in ((0, begin), (1, inside)):
            for piece in pieces:
                node = root
                for b in piece:
                    nxt = self.go.get(node << 8 | b)
                    if nxt is None:
                        nxt = self.go[node << 8 | b] = len(parent)
                        parent.append((node, b))
                        self.is_piece.append(False)
                    node = nxt
                if node > 1:
                    self.is_piece[node] = True
        self.fail = [-1] * len(parent)
        self.popped = [0] * len(parent)
        children: list[list[int]] = [[] for _ in parent]
        for node, (up, _) in enumerate(parent):
            if up >= 0:
                children[up].append(node)
        queue = deque(children[0] + children[1])
        while queue:
            v = queue.popleft()
            u, b = parent[v]
            if self.is_piece[v]:
                self.fail[v], self.popped[v] = 1, 1
            else:
                z, n = self.fail[u], self.popped[u]
                while z >= 0 and (z << 8 | b) not in self.go:
                    n += self.popped[z]
                    z = self.fail[z]
                if z >= 0:
                    self.fail[v], self.popped[v] = self.go[z << 8 | b], n
            queue.extend(children[v])

    def count(self, word: bytes) -> int:
        """Greedy pieces of the word; 0 if it has no such decomposition."""
        go, fail, popped = self.go.get, self.fail, self.popped
        node = n = 0
        for b in word:
            nxt = go(node << 8 | b)
            while nxt is None:
                n += popped[node]
                node = fail[node]
                if node < 0:
                    return 0
                nxt = go(node << 8 | b)
            node = nxt
        while node != 1:
            n += popped[node]
            node = fail[node]
            if node < 0:
                return 0
        return n


@functools.lru_cache(maxsize=1)
def automaton(rank_file: bytes) -> LongestMatch:
    """Pieces of a rank file: those with a leading space begin a word, single bytes
    do as well (so every word decomposes), and all others continue one."""
    tokens = list(token_bytes(rank_file).values())
    begin = [t[1:] for t in tokens if t[:1] == b" " and len(t) > 1 and b" " not in t[1:]]
    inside = [t for t in tokens if t.split() == [t]]
    return LongestMatch(begin + [t for t in inside if len(t) == 1], inside)


def count_pieces(df: DataFrame, text: str = "text", *, ranks: bytes | None = None,
                 keep: Sequence[str] | None = None) -> DataFrame:
    """Append ``n_words``, ``n_tokens`` and ``n_unknown`` of each text.

    Words are runs of non-space characters (Unicode white space separates). A
    word with no decomposition counts as one unknown token. Null and empty
    texts have zero of each; repeated rows get equal counts.
    """
    rank_file = read_ranks() if ranks is None else ranks

    def make():
        auto = automaton(rank_file)
        known: dict[str, int] = {}

        def counted(word: str) -> int:
            if len(known) >= CACHE_WORDS:
                known.clear()
            n = known[word] = auto.count(word.encode())
            return n

        def work(texts: pa.Array):
            n_words, n_tokens, n_unknown = [], [], []
            get = known.get
            for t in texts:
                words = t.as_py().split()
                counts = []
                for w in words:
                    n = get(w)
                    counts.append(counted(w) if n is None else n)
                unknown = counts.count(0)
                n_words.append(len(words))
                n_tokens.append(sum(counts) + unknown)
                n_unknown.append(unknown)
            return [pa.array(x, pa.int64()) for x in (n_words, n_tokens, n_unknown)]

        return work

    return add_columns(df, text, "n_words long, n_tokens long, n_unknown long", make, keep)


def op8_token_counts(spark, sf_dir: str) -> DataFrame:
    """Greedy word-piece counts of every whole document."""
    counted = count_pieces(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return counted.select("doc_id", "n_words", "n_tokens", "n_unknown",
                          F.round(F.try_divide("n_tokens", "n_words"), 6).alias("tokens_per_word"))
