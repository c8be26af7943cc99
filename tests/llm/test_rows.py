"""Row-wise operators against plain Python."""

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from martkit.llm import fingerprints, language, licences, quality, wordpiece
from martkit.llm.bpe import read_ranks, token_bytes

from .conftest import frame


def greedy(word, begin, inside):
    n, at, pieces = 0, 0, begin
    while at < len(word):
        end = next((e for e in range(len(word), at, -1) if word[at:e] in pieces), None)
        if end is None:
            return 0
        n, at, pieces = n + 1, end, inside
    return n


@given(st.lists(st.text("abc", min_size=1, max_size=4), max_size=12),
       st.lists(st.text("abc", min_size=1, max_size=4), max_size=12),
       st.text("abc", min_size=1, max_size=14))
@settings(max_examples=300, deadline=None)
def test_longest_match_automaton(begin, inside, word):
    a = [x.encode() for x in begin]
    b = [x.encode() for x in inside]
    auto = wordpiece.LongestMatch(a, b)
    assert auto.count(word.encode()) == greedy(word.encode(), set(a), set(b))


def test_token_counts(spark, corpus):
    tokens = list(token_bytes(read_ranks()).values())
    inside = {t for t in tokens if t.split() == [t]}
    begin = {t[1:] for t in tokens if t[:1] == b" " and len(t) > 1} | {t for t in inside if len(t) == 1}
    for r in wordpiece.count_pieces(frame(spark, corpus, n_words="clash")).collect():
        words = (corpus[r.doc_id] or "").split()
        counts = [greedy(w.encode(), begin, inside) for w in words]
        assert (r.n_words, r.n_tokens, r.n_unknown) == (
            len(words), sum(max(1, c) for c in counts), counts.count(0))
    assert wordpiece.count_pieces(frame(spark, [])).count() == 0


def test_matching_statistics_against_substrings():
    auto = licences.Automaton.build({"t": "a b c d a b e", "u": "b c x a b"}, {"b c": "bc", "x": "x"})
    parts = [t.split() for t in ("a b c d a b e", "b c x a b")]
    text = "z a b c x a b c d a q b b c".encode().split()
    hits, _ = auto.scan(text, 1)
    assert hits == [(2, "bc"), (4, "x"), (6, "bc"), (12, "bc")]
    for n in range(1, len(text) + 1):  # the longest suffix that stands in a template
        words = [w.decode() for w in text[:n]]
        best = max((k for k in range(n + 1) if k == 0 or any(
            words[n - k:] == p[i:i + k] for p in parts for i in range(len(p)))), default=0)
        matches = auto.scan(text[:n], 1)[1]
        assert (matches[-1][1] if matches and matches[-1][0] == n else 0) == best


def test_licence_spans(spark):
    mit = re.sub(r"\s+", " ", licences.TEMPLATES["mit-text"])
    texts = [None, "", mit, f"Some words. {mit.upper()} more", mit.replace("without limitation", "w l"),
             mit[:len(mit) // 3], "Released under the MIT License. The Apache license, a general "
             "public license.", "mit, license"]
    rows = {r.doc_id: r for r in licences.scan_licences(frame(spark, texts, spans=3)).collect()}
    assert rows[0].n_words == rows[1].n_words == 0 and rows[0].spans == []
    for i in (2, 3, 4):
        assert [s.label for s in rows[i].spans] == ["mit-text"], i
        assert rows[i].spans[0].coverage > 0.9
    assert rows[3].spans[0].first_word == 2
    assert rows[5].spans == []
    assert rows[6].phrase_labels == ["mit", "apache", "gpl"]
    assert rows[7].phrase_starts == [0]


def test_language(spark):
    train = spark.createDataFrame(
        [(i, ("the cat and the dog of the house " if i % 2 else "der hund und die katze im haus ")
          * 5 + str(i), "en" if i % 2 else "de") for i in range(80)] + [(99, "x y", None)],
        "doc_id long, text string, lang string")
    known = language.learn(train)
    assert sorted(known) == ["de", "en"]
    texts = [None, "", "123 456", "the dog of the cat", "die katze und der hund", "DER HUND"]
    rows = {r.doc_id: r for r in language.identify(frame(spark, texts, margin="x"), known).collect()}
    assert [rows[i].lang_pred for i in range(6)] == ["und", "und", "und", "en", "de", "de"]
    assert all(rows[i].rejected for i in range(3)) and not rows[3].rejected
    assert language.learn(train.limit(0)) == {}
    assert [r.lang_pred for r in language.identify(frame(spark, ["a"]), {}).collect()] == ["und"]


def test_quality(spark):
    good = [f"This is a plain sentence number {i}. It has some ordinary words, and more." for i in range(60)]
    bad = [f"BUY!! NOW!! {i}!! $$$ ### &&& CLICK!!" for i in range(60)]
    texts = good + bad + [None, ""]
    docs = frame(spark, texts, score="clash")
    labels = spark.createDataFrame([(i, int(i < 60)) for i in range(120)] + [(5000, 1), (None, 0)],
                                   "doc_id long, quality int")
    ranker = quality.learn(docs, labels)
    rows = {r.doc_id: r for r in quality.rate(docs, ranker).collect()}
    assert all(rows[i].predicted == int(i < 60) for i in range(120))
    assert all(0 <= r.score <= 1 for r in rows.values())
    flat = quality.rate(docs, quality.learn(docs, labels.filter("quality = 1"))).collect()
    assert all(r.score == pytest.approx(quality.CUT_SCORE) for r in flat)


def test_columns_are_added_in_slices_and_the_text_travels_once(spark):
    import pyarrow as pa
    from martkit.llm.common import SLICE, add_columns
    from conftest import plan_text

    def make():
        def work(texts):
            return [pa.array([sum(len(t.as_py()) for t in texts)] * len(texts), pa.int64())]

        return work

    docs = frame(spark, ["x" * 4000, None] * 900).repartition(1)
    out = add_columns(docs, "text", "n long", make)
    assert "__llm_text" not in plan_text(out)
    rows = out.collect()
    assert len(rows) == 1800 and max(r.n for r in rows) <= SLICE
    assert sum(r.text is None for r in rows) == 900  # a null text stays null beside the columns


def test_quality_learns_from_every_label(spark, monkeypatch):
    """Strengths, threshold and pairs are those of all labelled rows, in one block or in many."""
    import numpy as np
    assert "sample" not in quality.learn.__kwdefaults__
    texts = [f"A plain sentence number {i}. It has ordinary words." if i % 3
             else f"BUY!! {i}!! $$$ ### CLICK{'!' * (i % 7)}" for i in range(200)]
    docs = frame(spark, texts)
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(200)],
                                   "doc_id long, quality int")
    x = np.array([quality.features(t) for t in texts])
    for rows, rarer in ((2048, 64), (20, 4), (20, 64)):
        monkeypatch.setattr(quality, "BLOCK_ROWS", rows)
        monkeypatch.setattr(quality, "BLOCK_RARER", rarer)
        ranker = quality.learn(docs, labels)
        assert np.allclose(ranker.centre, x.mean(0), atol=1e-9)
        assert np.allclose(ranker.scale, np.maximum(x.std(0), 1e-3), atol=1e-6)
        assert ranker.cut == pytest.approx(np.quantile(ranker.strengths(x), 67 / 200), abs=1e-9)
        assert ranker == quality.learn(docs.repartition(7), labels.repartition(5))
        got = quality.rate(quality.describe(docs), ranker, described=True)
        assert all(r.predicted == int(r.doc_id % 3 > 0) for r in got.collect())
        assert "x" not in got.columns


def test_every_labelled_row_is_paired(spark, monkeypatch):
    """One bad row among many: it is copied to all blocks, so each good row has an opponent."""
    import numpy as np
    monkeypatch.setattr(quality, "BLOCK_ROWS", 10)
    rows = spark.createDataFrame([(int(h), h != 7, [float(h)]) for h in range(100)],
                                 "h long, good boolean, x array<double>")
    blocks = quality._blocks(rows, 100, 1, False).collect()
    assert sum(r.own for r in blocks) == 100
    assert {r.block for r in blocks if not r.good} == {r.block for r in blocks} == set(range(10))
    dealt = quality._blocks(rows, 100, 1, False)
    sums = quality._block_sums(dealt, np.zeros(1), np.ones(1), np.zeros(1))
    assert sums[0] == 100 * quality.PAIRS_PER_ROW


def chunks(raw, block):
    """Plain context-triggered pieces: the hash of the last seven bytes decides."""
    import numpy as np
    h = fingerprints.rolling(np.frombuffer(raw, np.uint8))
    return [i + 1 for i in range(len(raw)) if int(h[i]) % block == block - 1]


def test_fingerprints(spark, corpus, monkeypatch):
    rows = fingerprints.fingerprint(frame(spark, corpus)).collect()
    for r in rows:
        raw = (corpus[r.doc_id] or "").encode()
        block, one, two = r.fingerprint.split(":")
        ends = chunks(raw, int(block))
        assert len(one) == len(ends) + (bool(raw) and (not ends or ends[-1] < len(raw)))
    whole = fingerprints.fingerprint_of(("word salad " * 900).encode() + bytes(range(256)) * 30)
    monkeypatch.setattr(fingerprints, "_STEP", 997)  # segments do not change it
    assert fingerprints.fingerprint_of(("word salad " * 900).encode() + bytes(range(256)) * 30) == whole


def test_likeness(spark):
    from pyspark.sql import functions as F
    pairs = [("3:abcdefghij:xy", "3:abcdefghij:xy", 1.0), ("3:abcdefghij:", "6:k:", 0.0),
             ("3:abcdefghij:q", "3:abcdefghix:z", 0.9), ("12:abcdefgh:q", "3:abcdefgh:q", 0.0),
             ("6:abcdefghij:q", "3:zz:abcdefghij", 1.0), ("3::", "3::", 1.0), (None, "3::", None),
             ("3:abcdefghij:", "3:0123456789:", 0.0)]
    df = spark.createDataFrame(pairs, "a string, b string, want double")
    for r in df.withColumn("got", fingerprints.likeness(F.col("a"), F.col("b"))).collect():
        assert r.got == (None if r.want is None else pytest.approx(r.want)), r


def test_next_document(spark, tmp_path, corpus):
    ids = [7 * i % 101 - 20 for i in range(len(corpus))]
    rows = [(i, t) for i, t in zip(ids, corpus)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(5).write.parquet(
        str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in fingerprints.op5_fingerprints(spark, str(tmp_path)).collect()}
    order = sorted((i, t or "") for i, t in rows)
    assert len(got) == len(order)
    for k, (i, t) in enumerate(order):
        nxt, q = order[(k + 1) % len(order)][1], len(t) // 4
        edited = t[:len(t) - q] + nxt[:q]
        assert got[i].n_chars == len(t)
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert got[i].edited_fingerprint == fingerprints.fingerprint_of(edited.encode())


@pytest.mark.parametrize("ids", [[], [3], [None, None], [5, 5, 5, None]])
def test_next_document_odd_ids(spark, tmp_path, ids):
    spark.createDataFrame([(i, f"text {k} of it") for k, i in enumerate(ids)],
                          "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    assert fingerprints.op5_fingerprints(spark, str(tmp_path)).count() == len(ids)


def test_short_licence_inside_a_longer_partial_match(spark):
    part = ('Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file '
            "and then other text stands here")
    row = licences.scan_licences(frame(spark, [part])).collect()[0]
    assert [(s.label, s.first_word, s.last_word, s.coverage) for s in row.spans] == [
        ("apache-line", 0, 7, 1.0)]


def test_every_template_is_found_whole_and_changed(spark):
    """Each template as it stands, and with one word in fifteen put in, is reported."""
    from martkit.llm import licences
    names, texts = list(licences.TEMPLATES), []
    for name in names:
        words = licences.TEMPLATES[name].split()
        texts.append("intro words. " + " ".join(words) + " closing words.")
        texts.append(" ".join(w for i, w in enumerate(words, 1) for w in (
            [w, "inserted"] if i % 15 == 0 else [w])))
    found = {r.doc_id: {s.label for s in r.spans}
             for r in licences.scan_licences(frame(spark, texts)).collect()}
    for i, name in enumerate(names):
        assert name in found[2 * i] and name in found[2 * i + 1], name
    plain = frame(spark, ["the terms of the contract are free to copy, in any way, for any purpose"] * 3)
    assert all(not r.spans for r in licences.scan_licences(plain).collect())


def test_signatures_of_unbroken_texts_are_bounded():
    for text in ("x" * 300_000, "1 " * 30_000, "ab" * 100_000):
        block, one, two = fingerprints.fingerprint_of(text.encode()).split(":")
        assert len(one) <= fingerprints.LONGEST and len(two) <= fingerprints.LONGEST
    a, b = (fingerprints.fingerprint_of(("x" * n).encode()) for n in (300_000, 300_001))
    assert a != b  # the last piece takes the rest of the text
