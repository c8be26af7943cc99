"""op12: repeated 35-word windows by suffix trees against a dictionary of windows."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from martkit.llm import passages as P
from martkit.llm.passages import (inner_nodes, op12_repeated_passages, remove_passages,
                                  repeated_windows)

from .conftest import frame

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def expected(texts, window=35):
    """(n_words, n_removed, kept_sha256) of each text."""
    docs = [WORD.findall(t or "") for t in texts]
    seen = Counter(tuple(d[i:i + window]) for d in docs for i in range(len(d) - window + 1))
    out = []
    for d in docs:
        gone = set()
        for i in range(len(d) - window + 1):
            if seen[tuple(d[i:i + window])] > 1:
                gone.update(range(i, i + window))
        kept = " ".join(w for i, w in enumerate(d) if i not in gone)
        out.append((len(d), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def rows(df):
    return {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in df.collect()}


def shared(seed, n=60):
    """Texts over few words, with passages, near copies, copies and periodic stretches."""
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(200)]
    prose = lambda k: [rng.choice(vocab) for _ in range(k)]
    passages = [prose(rng.randint(30, 90)) for _ in range(6)]
    out = []
    for _ in range(n):
        words = prose(rng.randint(0, 50))
        for _ in range(rng.randint(0, 3)):
            p = list(rng.choice(passages))
            if rng.random() < 0.5:
                p[rng.randrange(len(p))] = "changed"
            words += p + prose(rng.randint(0, 20))
        out.append(rng.choice([" ", "\n", "\t "]).join(words))
    return [*out, out[0], out[1], "la " * 100, "a b c " * 60, " ".join(["x"] * 36), None, ""]


def test_rows_equal_brute_force(spark, corpus):
    texts = [*corpus, *shared(1), "x" * 1_000_000, "1 " * 3000]
    df = frame(spark, texts, N_WORDS="clash", node="clash", words=3)
    out = remove_passages(df, keep=["doc_id", "node", "words"])
    assert out.columns == ["doc_id", "node", "words", "n_words", "n_removed", "kept_sha256"]
    assert rows(out) == dict(enumerate(expected(texts)))


@pytest.mark.parametrize("group", [1, 3, 12])
def test_longer_prefixes_and_whole_windows(spark, group):
    texts = shared(2, n=40)
    out = remove_passages(frame(spark, texts), keep=["doc_id"], group=group)
    assert rows(out) == dict(enumerate(expected(texts)))


def test_hot_prefixes_pass_the_census(spark, monkeypatch):
    texts = shared(3, n=40)
    monkeypatch.setattr(P, "hot_keys", lambda t, keys, total: np.sort(np.array(
        [r["h"] for r in keys(t).select("h").distinct().collect()][::2], dtype=np.int64)))
    out = remove_passages(frame(spark, texts), keep=["doc_id"], group=2)
    assert rows(out) == dict(enumerate(expected(texts)))


def test_other_sizes(spark):
    texts = shared(4, n=30)
    out = remove_passages(frame(spark, texts), keep=["doc_id"], window=20, name=6)
    assert rows(out) == dict(enumerate(expected(texts, window=20)))


def test_hash_collisions_do_not_remove_words(spark, monkeypatch):
    """Every 12 words hash alike: the trees compare words."""
    texts = shared(5, n=8)[:8]
    words = [WORD.findall(t) for t in texts]
    ids = {w: i for i, w in enumerate(sorted({w for d in words for w in d}))}
    flat = np.array([ids[w] for d in words for w in d])
    starts, group, off, n, base = [], [], [], [], [0]
    parts = []
    first = 0
    for d in words:
        for i in range(len(d) - 34):
            parts.append(flat[first + i:first + i + 35])
            starts.append(tuple(parts[-1]))
            group.append(0)
            off.append(0)
            n.append(1)
            base.append(base[-1] + 35)
        first += len(d)
    marks = repeated_windows(np.array(group), np.concatenate(parts), np.array(base),
                             np.array(off), np.array(n), 35, 12)
    count = Counter(starts)
    assert marks[:, 0].tolist() == [count[s] > 1 for s in starts]
    assert not marks[:, 1:].any()


def test_inner_nodes_are_common_prefixes():
    m = np.array([[1, 2, 3], [1, 2, 4], [0, 9, 9], [1, 2, 3]])
    order, lcp = inner_nodes(m)
    assert m[order].tolist() == sorted(m.tolist())
    assert lcp.tolist() == [0, 3, 2]


def test_repeated_rows_empty_tables_and_null_ids(spark):
    long = " ".join(f"w{i}" for i in range(40))
    df = spark.createDataFrame([(1, long), (1, long), (None, long + " x"), (2, None), (3, "w1")],
                               "doc_id long, text string")
    got = sorted(((r["doc_id"] or 0, r["n_words"], r["n_removed"])
                  for r in remove_passages(df).collect()))
    assert got == [(0, 41, 40), (1, 40, 40), (1, 40, 40), (2, 0, 0), (3, 1, 0)]
    assert remove_passages(df.limit(0)).collect() == []


def test_query_over_the_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = expected([r["text"] for r in docs])
    assert rows(op12_repeated_passages(spark, sf)) == {r["doc_id"]: w for r, w in zip(docs, want)}
    assert sum(w[1] for w in want) > 0
