"""op13: runs by grammar compression against a scan of every shift, and the query's contract."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from martkit.llm import runs as R
from martkit.llm.runs import find_runs, op13_periodic_runs, periodic_runs, repeat_tails, scan_runs

from .conftest import frame

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(x):
    """Every run of one sequence, by walking along each shift."""
    n, best = len(x), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            s = i
            while i + q < n and x[i] == x[i + q]:
                i += 1
            if i > s and i + q - s >= max(6, 4 * q):
                best.setdefault((s, i + q), q)
            i += i == s
    return sorted((a, z, q) for (a, z), q in best.items())


def expected(doc_id, text):
    """The contract's row, word by word."""
    words = WORD.findall(text or "")
    if doc_id is not None and words:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = sorted((a, z - a, q) for a, z, q in brute(words))
    big = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    drop = {i for a, n, q in found for i in range(a + q, a + n)}
    kept = " ".join(w for i, w in enumerate(words) if i not in drop)
    lines = "".join(f"{a},{n},{q}\n" for a, n, q in found)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (len(found), *(big or (None,) * 3), 1000 * big[1] // big[2] if big else None,
            sha(lines), sha(kept))


def random_docs(rng, n):
    docs = []
    for _ in range(n):
        k = rng.randint(1, 6)
        x = [rng.randrange(k) for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            p = [rng.randrange(k) for _ in range(rng.randint(1, 9))]
            at = rng.randint(0, len(x))
            x[at:at] = (p * 12)[:rng.randint(1, 60)]
        docs.append(x)
    return docs


def rows_of(docs):
    ids = np.array(sum(docs, []), dtype=np.int64)
    first = np.cumsum([0] + [len(d) for d in docs])
    got = list(zip(*(c.tolist() for c in find_runs(ids, first))))
    return [(d, a - int(first[d]), z - int(first[d]), q) for d, a, z, q in got]


def test_runs_equal_brute_force():
    rng = random.Random(3)
    for _ in range(80):
        docs = random_docs(rng, rng.randint(1, 6))
        assert rows_of(docs) == [(d, *r) for d, x in enumerate(docs) for r in brute(x)]


def test_scan_equals_brute_force():
    rng = random.Random(4)
    for x in random_docs(rng, 60):
        assert scan_runs(np.array(x, dtype=np.int64)) == brute(x)


def test_grammar_derives_the_text():
    rng = random.Random(5)
    docs = [d for d in random_docs(rng, 20) if d]
    ids = np.array(sum(docs, []), dtype=np.int64)
    first = np.cumsum([0] + [len(d) for d in docs])
    g = R.Grammar(ids, first)

    def expand(s):
        return [int(g.place[s])] if s < g.words else expand(g.left[s]) + expand(g.right[s])

    for d, root in zip(range(len(docs)), g.roots):
        assert [int(ids[i]) for i in expand(root)] == docs[d]
    periodic = R.Grammar(np.zeros(4096, dtype=np.int64), np.array([0, 4096]))
    assert len(periodic.length) < 30  # a symbol is looked at once, however often it stands


def test_hash_collisions_fall_back_to_the_words(monkeypatch):
    # every two stretches are alike
    monkeypatch.setattr(R.WordSums, "equal", lambda self, at, period, n: np.ones(len(at), bool))
    docs = [[1, 2, 1, 2, 1, 2, 1, 2, 1, 9], [3, 3, 3, 3, 3, 3, 1], [1, 2, 3, 4, 5, 6, 7, 8]]
    assert rows_of(docs) == [(d, *r) for d, x in enumerate(docs) for r in brute(x)]


def test_long_unbroken_texts_end_soon():
    for x in ([0] * 50_000, [0, 1, 2] * 20_000, list(range(5000)) * 8):
        ids = np.array(x, dtype=np.int64)
        _, s, e, _ = find_runs(ids, np.array([0, len(ids)]))
        assert (s.tolist(), e.tolist()) == ([0], [len(ids)])


def contract(rows):
    return {r["doc_id"]: tuple(r[c] for c in (
        "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
        "collapsed_sha256")) for r in rows}


def test_rows_equal_the_contract(spark, corpus):
    texts = [*corpus, "x" * 1_000_000, "1" * 1_000_000, "a b " * 40, "a\x1fb " * 9]
    df = frame(spark, texts, N_RUNS="clash", start="clash", runs="clash")
    out = periodic_runs(repeat_tails(df), keep=["doc_id"])
    assert out.columns[:2] == ["doc_id", "n_runs"]
    assert contract(out.collect()) == {i: expected(i, t) for i, t in enumerate(texts)}


def test_null_ids_repeated_rows_and_empty_tables(spark):
    rows = [(None, "la " * 9), (None, None), (7, "b c " * 5), (7, "b c " * 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = periodic_runs(repeat_tails(df)).collect()
    assert len(out) == 4
    for r in out:
        text = dict([(None, "la " * 9)]).get(r["doc_id"], "b c " * 5)
        want = expected(r["doc_id"], text if r["n_runs"] else None)
        assert contract([r])[r["doc_id"]] == want
    assert periodic_runs(repeat_tails(df.limit(0))).collect() == []


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_query_over_the_whole_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = contract(op13_periodic_runs(spark, sf).collect())
    assert got == {r["doc_id"]: expected(r["doc_id"], r["text"]) for r in docs}
    assert sum(r[0] for r in got.values()) > 0
