"""Operators over the whole corpus against brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import pytest

from martkit.llm import decontaminate, jaccard, pii, repeats, substrings

from .conftest import frame


def shingles(text):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def brute_components(texts):
    sets = [shingles(t) for t in texts]
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(texts))], [len(s) for s in sets]


@pytest.mark.parametrize("wide,block", [(4096, 512), (4096, 3), (3, 2)])
def test_near_duplicates(spark, corpus, monkeypatch, wide, block):
    monkeypatch.setattr(jaccard, "WIDE", wide)
    monkeypatch.setattr(jaccard, "BLOCK", block)
    comps, sizes = brute_components(corpus)
    rows = jaccard.near_duplicates(frame(spark, corpus, component="clash")).collect()
    assert {(r.doc_id, r.n_shingles, r.component) for r in rows} == set(
        zip(range(len(corpus)), sizes, comps))
    assert len(set(comps)) < len(comps) - 8


def test_keep_one(spark, corpus):
    comps, sizes = brute_components(corpus)
    twice = frame(spark, corpus).union(frame(spark, corpus))
    got = sorted(r.doc_id for r in jaccard.keep_one(twice).collect())
    empty = [i for i, n in enumerate(sizes) if not n]
    assert got == sorted([*{c for c, n in zip(comps, sizes) if n}, *empty, *empty])
    assert jaccard.keep_one(frame(spark, [])).count() == 0
    assert jaccard.near_duplicates(frame(spark, [None, ""])).count() == 2


@pytest.mark.parametrize("percent", [30, 50])
def test_near_duplicates_of_unlike_sizes(spark, percent):
    words = [f"w{i}" for i in range(64)]
    lengths = (64, 35, 24, 20)  # 60, 31, 20 and 16 shingles
    texts = [" ".join(words[:n]) for n in lengths] + [" ".join(f"x{i}" for i in range(64))]
    got = [r.component for r in sorted(jaccard.near_duplicates(
        frame(spark, texts), percent=percent).collect())]
    want = list(range(len(texts)))
    sets = [shingles(t) for t in texts]
    for i, a in enumerate(sets):  # each text is a part of the one before it
        if i and 100 * len(a & sets[i - 1]) >= percent * len(a | sets[i - 1]):
            want[i] = want[i - 1]
    assert got == want == [0, 0, 0, 0, 4]


def test_pairs_of_a_group_do_not_become_rows(spark, monkeypatch):
    """Ten groups of near copies whose points are near one another, but not linked."""
    base = [f"w{i}" for i in range(60)]
    texts = [" ".join(f"x{k}" if i == 10 + 4 * (k % 10) else w for i, w in enumerate(base))
             for k in range(120)]
    made, plain = [], jaccard.grouped

    def counted(rows, key, schema, work, **more):
        out = plain(rows, key, schema, work, **more)
        if {"a", "b"} <= set(out.columns):
            made.append(out.count())
        return out

    monkeypatch.setattr(jaccard, "grouped", counted)
    rows = jaccard.near_duplicates(frame(spark, texts)).collect()
    assert {(r.doc_id, r.component) for r in rows} == {(k, k % 10) for k in range(120)}
    assert max(made) <= 2 * len(texts)


def test_tree_bound_never_loses_a_link():
    import numpy as np
    rng = np.random.default_rng(3)
    sets = []
    for n in (1, 4, 30, 200, 255, 256, 300, 1000):
        base = np.sort(rng.integers(1, 1 << 55, n))
        sets.append(base)
        for share in (0.02, 0.05, 0.1):
            other = base.copy()
            k = int(share * n)
            other[rng.permutation(n)[:k]] = rng.integers(1, 1 << 55, k)
            sets.append(np.unique(other))
    for a in sets:
        for b in sets:
            n, c = jaccard.unpacked([jaccard.point_of(a), jaccard.point_of(b)])
            both = len(np.intersect1d(a, b))
            assert jaccard.overlap_bound(c[:1], c[1:])[0] >= both
            tree = jaccard.CountTree(n[:1], c[:1])
            found = len(tree.search(n[1:], c[1:])[0])
            if 100 * both >= 80 * (len(a) + len(b) - both):
                assert found == 1


def test_tree_search_equals_scan():
    import numpy as np
    rng = np.random.default_rng(4)
    points = rng.poisson(3, (300, 16)).astype(np.int32)
    sizes = points.sum(1).astype(np.int64)
    tree = jaccard.CountTree(sizes, points, leaf=4)
    q, at = tree.search(sizes[:50], points[:50])
    want = {(i, j) for i in range(50) for j in range(300)
            if 80 * max(sizes[i], sizes[j]) <= 100 * min(sizes[i], sizes[j])
            and np.minimum(points[i], points[j]).sum() >= jaccard.needed(sizes[i], sizes[j])}
    assert set(zip(q.tolist(), at.tolist())) == want


@pytest.mark.parametrize("per_task", [200_000, 3, 1])
def test_components(spark, per_task):
    edges = [(b"%02d" % a, b"%02d" % b) for a, b in
             [(1, 2), (2, 3), (3, 4), (9, 8), (8, 7), (20, 30), (30, 40), (40, 4), (5, 5)]]
    got = {r.node: r.comp for r in repeats.components(
        spark.createDataFrame(edges, "a binary, b binary"), per_task=per_task).collect()}
    want = {b"%02d" % k: b"01" for k in (1, 2, 3, 4, 20, 30, 40)} | {
        b"%02d" % k: b"07" for k in (7, 8, 9)}
    assert {bytes(k): bytes(v) for k, v in got.items()} == want
    assert repeats.components(spark.createDataFrame([], "a binary, b binary")).count() == 0


@pytest.mark.parametrize("batch", [1, 3, 10_000])
def test_repeated(spark, batch):
    import random
    rng = random.Random(batch)
    rows = [(rng.randrange(12), bytes([rng.randrange(4)]) * 16) for _ in range(90)] + [
        (100 + i, b"z" * 16) for i in range(30)] + [(55, b"q" * 16)] * 4
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        got = sorted((r.h, bytes(r.node)) for r in repeats.repeated(
            spark.createDataFrame(rows, "h long, node binary"), "h", ["node"]).collect())
        merged = repeats.repeated(spark.createDataFrame(rows, "h long, node binary"), "h", ["node"],
                                  collapse=True).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    members = defaultdict(set)
    for h, node in rows:
        members[h].add(node)
    want = sorted((h, n) for h, m in members.items() if len(m) > 1 for n in m)
    assert got == want
    cells = defaultdict(set)
    for r in merged:
        cells[r.h].add(bytes(r.node))
    assert {frozenset(m) for m in cells.values()} == {
        frozenset(m) for m in members.values() if len(m) > 1}


def brute_repeats(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[i:i + length] for r in raw for i in range(len(r) - length + 1))
    out = []
    for r in raw:
        gone = [False] * len(r)
        for i in range(len(r) - length + 1):
            if seen[r[i:i + length]] > 1:
                gone[i:i + length] = [True] * length
        rest = bytes(b for b, g in zip(r, gone) if not g)
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(r), sum(gone), runs, hashlib.sha256(rest).hexdigest()))
    return out


@pytest.mark.parametrize("length,name,crowd,segment", [
    (200, 64, 5000, 1 << 16), (40, 16, 3, 1 << 16), (40, 40, 5000, 97), (24, 8, 1, 1000)])
def test_removed_bytes(spark, corpus, monkeypatch, length, name, crowd, segment):
    monkeypatch.setattr(substrings, "SEGMENT", segment)
    want = brute_repeats(corpus, length)
    rows = substrings.remove_repeats(frame(spark, corpus, n_bytes="clash"), length=length, name=name,
                                     crowd=crowd).collect()
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows}
    assert got == dict(enumerate(want))
    assert sum(w[1] for w in want) > 1000


def test_removed_bytes_empty(spark):
    assert substrings.remove_repeats(frame(spark, [])).count() == 0
    assert [r.n_removed for r in substrings.remove_repeats(frame(spark, [None, "ab"])).collect()] == [0, 0]


ITEM = ("Mister Brown buys 12 apples and 5 pears in the old market of Springfield, then gives 5 pears "
        "to a friend; how many kg does he carry home if an apple weighs 3 kg and a pear 2 kg today")


def leaks(spark, texts, items, **more):
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = decontaminate.find_leaks(frame(spark, texts, leaks="clash"), bench, **more).collect()
    return {r.doc_id: sorted((x.item, x.changed_slots > 0) for x in r.leaks) for r in rows}


def test_benchmark_leaks(spark):
    again = (ITEM.replace("12", "40").replace(" 5 ", " 9 ").replace("Springfield", "Rivertown")
             .replace("3 kg", "7 kg"))
    torn = ITEM.replace(" 5 pears in", " 8 pears in").replace("gives 5", "gives 6").replace(
        "weighs 3", "weighs 4").replace("pear 2 kg", "pear 9 kg")
    texts = [None, "", f"Intro words. {ITEM}\nOutro.", ITEM.upper().lower(), f"So: {again}!",
             "nothing of the kind stands in this text at all, only other words", ITEM[:60], torn]
    items = [(1, ITEM), (2, None), (3, "too short"), (None, "a b c")]
    got = leaks(spark, texts, items)
    assert got[2] == [("1", False)] and got[4] == [("1", True)]
    assert got[0] == got[1] == got[5] == got[6] == []
    assert leaks(spark, texts, items, index_words=5) == got  # several passes
    assert leaks(spark, [], items) == {} and leaks(spark, ["a"], []) == {0: []}


def test_verbatim_leaks_without_template_windows(spark):
    """Items dense in numbers or names, or all in capitals, are found as they stand."""
    items = [(1, "Add 12 + 7 - 3 * 4 + 19 - 8 + 2 * 6 and 31 - 5 + 77 = 90"),
             (2, "WHICH OF THE FOLLOWING PLANETS IS THE CLOSEST ONE TO THE SUN AND HAS NO MOON AT ALL IN ORBIT"),
             (3, "Did Anna Smith, Bob Brown, Carl Jones, Dora Klein, Emil Frank, Greta Lund and Hans Berg meet?"),
             (4, "Is 7 + 8 = 15 ok")]
    texts = [f"Some words before it. {t} Other words follow." for _, t in items]
    texts.append(texts[1].lower())
    texts.append("Add 1 + 2 - 3 * 5 + 18 - 9 + 3 * 7 and 32 - 6 + 78 = 91, which are other numbers")
    got = leaks(spark, texts, items)
    assert [got[i] for i in range(4)] == [[(str(i), False)] for i in (1, 2, 3, 4)]
    assert got[4] == [("2", False)] and got[5] == []


def test_leaks_with_words_put_in_or_left_out(spark):
    """Pieces of an item near each other and in order are one copy, others are not."""
    w = ITEM.split()
    third = len(w) // 3
    a, b, c = w[:third], w[third:2 * third], w[2 * third:]
    text = lambda *parts: " ".join(x for p in parts for x in p)
    far = [f"filler{i}" for i in range(3 * len(w))]
    other = [x.replace("12", "40").replace("5", "9") for x in w]
    texts = [text(a, ["really"], b, ["just"], c), text(a, b[1:], c[1:]),
             text(other[:third], ["really"], other[third:2 * third], ["just"], other[2 * third:]),
             text(c, ["and"], b, ["or"], a), text(a, far, b, far, c)]
    got = leaks(spark, texts, [(1, ITEM)])
    assert got[0] == got[1] == [("1", False)] and got[2] == [("1", True)]
    assert got[3] == got[4] == []


def test_slots_must_bind_one_to_one():
    index = decontaminate.Index([("x", "w1a has 5 red boxes and w2a has 5 blue boxes over there now")], 6, 3)
    import numpy as np
    import pyarrow as pa
    from martkit.llm.common import raw_bytes

    def cover(text):
        data, offsets = raw_bytes(pa.array([text]))
        c = decontaminate.canonical(data, offsets, index.units)
        found = [(p, q, w) for _, p, i, q, w in index.hits(c) if p - q == 0]
        return index.judge(c, 0, 0, found)

    assert np.isclose(cover("w1a has 7 red boxes and w2a has 7 blue boxes over there now")[0], 1)
    assert cover("w1a has 7 red boxes and w2a has 8 blue boxes over there now")[0] < 1


def spans(text):
    out = []
    for kind, pattern, ok in (
            ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
            ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
             lambda m: all(int(x) <= 255 for x in m.split("."))),
            ("card", r"[0-9]([\x20-]?[0-9])+",
             lambda m: 16 <= len(re.sub("[ -]", "", m)) <= 19 and pii.luhn(re.sub("[ -]", "", m))),
            ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= sum(map(str.isdigit, m)) <= 15)):
        out += [(kind, m.start(), m.end()) for m in re.finditer(pattern, text) if ok(m.group())]
    return out


PERSONAL = ["write to a.b@x.org, c@d, e@@f.g, q@w@e.r.t or é@x.yz", "at 1.2.3.4.5 or 256.1.1.1 or 01.002.3.4",
            "card 4111 1111 1111 1111 and 4111-1111-1111-1112, 4111111111111111 4111",
            "call +49 (30) 123-4567 or +1 2 or +1234567890123456", "..@a.b%@-.c", None, "", "@.@a.@b.c@"]


def test_base_spans(spark):
    for t in PERSONAL:
        assert pii.base_spans(t or "") == spans(t or "")
    rows = pii.detect(frame(spark, PERSONAL, base=1)).collect()
    assert {r.doc_id: [tuple(b) for b in r.base] for r in rows} == {
        i: spans(t or "") for i, t in enumerate(PERSONAL)}


def test_disclosing_terms(spark):
    filler = [f"plain words number {chr(97 + i % 26)}{chr(97 + i // 26)} of the common sort" for i in range(60)]
    told = [f"the agent Zorblax met {w} bob@corp.com and left the common place" for w in
            ("quietly", "often", "there", "again")]
    texts = filler + told + told + [None, "mail amy@corp.com once, rarely"]
    terms = {(bytes(r.key), r.start, r.action) for r in pii.disclosing_terms(frame(spark, texts)).collect()}
    key = lambda t: hashlib.md5(t.encode()).digest()
    for t in told:  # only words that stand with the entity and nowhere else
        assert "Zorblax" in {t[s:].split()[0] for k, s, _ in terms if k == key(t)}
        assert not {"the", "common"} & {t[s:].split()[0] for k, s, _ in terms if k == key(t)}
    assert {k for k, _, _ in terms} == {key(t) for t in told}
    clean = {r.doc_id: r.text for r in pii.sanitise(frame(spark, texts, key="x", terms=2)).collect()}
    assert [clean[i] for i in range(60)] == filler and clean[68] is None
    assert "Zorblax" not in clean[60] and "<EMAIL>" in clean[60] and "common" in clean[60]
    assert clean[69] == "mail <EMAIL> once, rarely"
    assert pii.sanitise(frame(spark, [])).count() == 0


def test_disclosing_terms_of_rare_entities(spark):
    """A person named in one or two texts: the words that only those texts hold give them away."""
    filler = [f"plain words number {chr(97 + i % 26)}{chr(97 + i // 26)} of the common sort" for i in range(400)]
    one = "the agent Zorblax met amy@corp.com of the common sort"
    two = [f"the common {w} Quixby wrote to bob@corp.com" for w in ("words", "number")]
    terms = pii.disclosing_terms(frame(spark, [*filler, one, one, *two])).collect()
    key = lambda t: hashlib.md5(t.encode()).digest()
    told = lambda t: {t[r.start:r.end] for r in terms if bytes(r.key) == key(t)}
    assert told(one) == {"agent", "Zorblax", "met"}
    assert [told(t) for t in two] == [{"Quixby", "wrote", "to"}] * 2
    assert len({bytes(r.key) for r in terms}) == 3


def test_disclosing_terms_far_from_the_entity(spark):
    """Terms are judged and counted over whole texts, wherever they stand."""
    filler = [f"plain words number {chr(97 + i % 26)}{chr(97 + i // 26)} of the common sort" for i in range(60)]
    rest = " of the plain common words number sort" * 3
    told = [f"Zorblax{rest}{rest} {w} bob@corp.com{rest} Quixby +49 30 1234567 Quixby{rest}"
            for w in ("plain", "common", "words")]
    told.append(f"Quixby{rest} bob@corp.com{rest} Zorblax the Zorblax")
    terms = pii.disclosing_terms(frame(spark, [*filler, *told])).collect()
    key = lambda t: hashlib.md5(t.encode()).digest()
    for t in told:
        found = sorted(t[r.start:r.end] for r in terms if bytes(r.key) == key(t))
        assert found == sorted(w for w in t.split() if w in ("Zorblax", "Quixby"))
    assert {bytes(r.key) for r in terms} == {key(t) for t in told}


def test_strings_of_one_key_are_told_apart_by_their_bytes():
    import numpy as np
    rng = np.random.default_rng(3)
    for alike in (True, False):
        data = rng.integers(97, 99, 60).astype(np.uint8)
        data[40:] = data[10:30]
        length, n = 8, 53
        place = np.arange(n)
        real = np.array([hash(data[i:i + length].tobytes()) & (1 << 60) - 1 for i in place],
                        dtype=np.uint64)
        key = np.zeros(n, np.uint64) if alike else real  # alike: every string has the one key
        want = Counter(data[i:i + length].tobytes() for i in place)
        got = substrings.same_strings(key, np.zeros(n, np.int64), place, data, length)
        assert got.tolist() == [want[data[i:i + length].tobytes()] > 1 for i in place]
