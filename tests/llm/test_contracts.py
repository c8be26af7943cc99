"""The registered queries over odd tables, against what their contracts say.

The tables hold null texts and ids, repeated rows, ties, empty and very long
texts (hundreds of thousands of equal characters), and extra columns whose names clash with
those of the operators; another folder holds the same tables without rows.
"""

import hashlib
import re
import zlib

import numpy as np
import pytest

from martkit.llm import bpe
from martkit.llm.queries import QUERIES

from .conftest import SCHEMA
from .test_corpus import brute_components, spans

CLASH = ["score", "Node", "key", "ids", "t", "n_words", "component_id", "held_out", "leaks",
         "base", "h", "x", "row", "spans", "fingerprint", "N_BYTES"]
DOCS = [n for n in QUERIES if n not in ("op7_decontaminate", "op11_prefix_trie")]


@pytest.fixture(scope="module")
def rows(corpus):
    people = ["mail bob.b@corp.com or call +49 (30) 123-4567 from 10.0.0.1 with 4111 1111 1111 1111",
              "under the MIT License and the Apache  License; general public license", "ÄÖ éß 😀 x"]
    texts = [*corpus, *people, "x" * 300_000, "1" * 300_000, "1 " * 30_000]
    out = [(i, t) for i, t in enumerate(texts)]
    return out + [(3, texts[3]), (len(out), texts[8]), (None, "no id here"), (None, None)]


@pytest.fixture(scope="module")
def folders(spark, rows, tmp_path_factory):
    docs = spark.createDataFrame(
        [(i, t, ["en", "de", None][n % 3], "s", len(t or "")) for n, (i, t) in enumerate(rows)],
        SCHEMA)
    for n, c in enumerate(CLASH):
        from pyspark.sql import functions as F
        docs = docs.withColumn(c, F.lit(["a", 1, None, True][n % 4]))
    marks = spark.createDataFrame([(i, i % 2, 0) for i in range(len(rows) - 4)] + [
        (None, 1, 0), (3, None, 0), (5, 0, 0)], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, "how many of the 12 red boxes in Berlin weigh more than 5 kg now"),
                                   (2, None), (None, "")], "item_id long, text string")
    talk = spark.createDataFrame([(1, 0, "user", "a"), (None, None, None, None)],
                                 "conv_id long, turn long, role string, text string")
    out = {}
    for name, cut in (("odd", lambda df: df), ("empty", lambda df: df.limit(0))):
        out[name] = str(tmp_path_factory.mktemp(name))
        for table, df in (("documents", docs), ("labels", marks), ("benchmark", bench),
                          ("conversations", talk)):
            cut(df.coalesce(2)).write.parquet(f"{out[name]}/{table}.parquet")
    return out


@pytest.fixture(scope="module")
def results(spark, folders):
    return {n: [r.asDict() for r in QUERIES[n](spark, folders["odd"]).collect()] for n in DOCS}


def by_id(found, *columns):
    return sorted(((r["doc_id"] is None, r["doc_id"] or 0), *(r[c] for c in columns))
                  for r in found)


def want_by_id(rows, make):
    return sorted(((i is None, i or 0), *make(t or "")) for i, t in rows)


@pytest.mark.parametrize("name", DOCS)
def test_a_row_for_each_row(results, rows, name):
    assert len(results[name]) == len(rows)
    assert by_id(results[name]) == sorted((((i is None, i or 0),) for i, _ in rows))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables_give_no_rows(spark, folders, name):
    out = QUERIES[name](spark, folders["empty"])
    assert out.collect() == [] and len(out.columns) == len(set(out.columns))


def test_op1(results, rows):
    library = bpe.encoding(bpe.read_ranks(), bpe.public_tokenizers.PATTERN)

    def make(t):
        ids = np.array(library.encode_ordinary(t), dtype="<u4").tobytes()
        return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(t.encode()).hexdigest()

    assert by_id(results["op1_byte_bpe"], "n_tokens", "ids_sha256", "decoded_sha256") == want_by_id(
        rows, make)


def test_op2(results, rows):
    def make(t):
        found = [] if len(t) > 100_000 else spans(t)
        listed = ",".join(f"{k}:{s}:{e}" for k, s, e in found)
        return (*(sum(k == x for k, _, _ in found) for x in ("email", "ip", "card", "phone")),
                hashlib.sha256(listed.encode()).hexdigest())

    got = results["op2_pii"]
    assert by_id(got, "n_email", "n_ip", "n_card", "n_phone", "base_sha256") == want_by_id(rows, make)
    for r in got:
        kinds = [x.split(":")[0] for x in r["spans"].split(",") if x]
        assert [k for k in kinds if k != "term"] == sorted(
            (k for k in kinds if k != "term"), key=("email", "ip", "card", "phone").index)


def test_op3(results, rows):
    phrases = {("mit", "license"): "mit", ("apache", "license"): "apache",
               ("general", "public", "license"): "gpl"}

    def make(t):
        low = re.sub("[A-Z]", lambda m: m.group().lower(), t)
        words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)
        at = [(i, label) for p, label in phrases.items()
              for i in range(len(words) - len(p) + 1) if tuple(words[i:i + len(p)]) == p]
        first = min((i for i, _ in at), default=-1)
        return (len(words), len(at), first, max((i for i, _ in at), default=-1),
                ",".join(sorted({x for _, x in at})))

    got = [{**r, **{c: -1 if r[c] is None else r[c] for c in ("first_word", "last_word")}}
           for r in results["op3_licence_scan"]]
    assert by_id(got, "n_words", "n_base", "first_word", "last_word", "base_labels") == want_by_id(
        rows, make)
    for r in got:
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1


def out_of_fit(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2


def test_op4(results, rows):
    texts = {}
    for r, (i, t) in zip(sorted(results["op4_quality"], key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0)),
                         sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))):
        assert r["held_out"] == out_of_fit(i)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
        if i is not None:
            assert texts.setdefault(t or "", r["score"]) == r["score"]  # equal texts, equal scores


def test_op4_scores_equal_the_formula(spark, rows):
    """Scores of a fitted ranking, recomputed row by row in plain Python."""
    from martkit.llm import quality
    ranker = quality.Ranker(tuple(np.linspace(-1, 1, 16)), (0.1,) * 16, (0.5,) * 16, 0.3)
    df = spark.createDataFrame([(n, t) for n, (_, t) in enumerate(rows)], "n long, text string")
    for r in quality.rate(df, ranker).collect():
        strength = sum(w * max(-8, min(8, (v - c) / s)) for w, v, c, s in zip(
            ranker.weights, quality.features(r["text"] or ""), ranker.centre, ranker.scale))
        logit = np.log(0.7 / 0.3) + strength - 0.3
        assert r["score"] == pytest.approx(1 / (1 + np.exp(-logit)), rel=1e-9)


def test_op5(spark, results, rows, folders):
    ordered = sorted((i, t or "") for i, t in rows if i is not None and (i, t) != (3, rows[3][1]))
    after = {i: ordered[(n + 1) % len(ordered)][1] for n, (i, _) in enumerate(ordered)}
    own = dict(ordered)
    prints = {}
    for r in results["op5_fingerprints"]:
        t = own.get(r["doc_id"], None)
        if t is None:
            continue
        assert r["n_chars"] == len(t)
        assert prints.setdefault(t, r["fingerprint"]) == r["fingerprint"]
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        if r["doc_id"] not in (3, max(own)):  # the repeated id, and the last (null ids sort apart)
            cut = len(t) // 4
            edited = t[:len(t) - cut] + after[r["doc_id"]][:cut]
            assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest(), r["doc_id"]


def test_op6(results, rows):
    known = [(i, t) for i, t in rows if i is not None]
    comps, sizes = brute_components([t for _, t in known])
    least = {}
    for c, (i, _) in zip(comps, known):
        least[c] = min(least.get(c, i), i)
    want = sorted((i, n, least[c]) for (i, _), n, c in zip(known, sizes, comps))
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"])
                 for r in results["op6_jaccard_join"] if r["doc_id"] is not None)
    linked = {i for i, t in known if t}  # empty sets are linked with nothing but have rows
    assert [g for g in got if g[0] in linked] == [w for w in want if w[0] in linked]


def test_op8(results, rows):
    assert all(n is not None and n >= 0 for r in results["op8_token_counts"]
               for c, n in r.items() if c.startswith("n_"))


def test_op9(results, rows):
    for r in results["op9_language_id"]:
        assert r["held_out"] == out_of_fit(r["doc_id"])
        assert r["lang_pred"] in ("en", "de", "und") and 0 <= r["score"] <= 1
    texts = dict((i, t) for i, t in rows if i is not None)
    for r in results["op9_language_id"]:
        if r["doc_id"] is not None and not re.search(r"[^\W\d_]", texts[r["doc_id"]] or ""):
            assert r["lang_pred"] == "und"


def test_op10(results, rows):
    """Windows of 200 bytes of short texts by a dictionary; the long unbroken ones by reasoning."""
    from collections import Counter
    raws = [(i, (t or "").encode()) for i, t in rows]
    short = [(i, r) for i, r in raws if len(r) < 50_000]
    seen = Counter(r[k:k + 200] for _, r in short for k in range(len(r) - 199))
    for _, r in raws:
        if len(r) >= 50_000:  # periodic: two windows tell which others it holds
            seen.update({r[k:k + 200]: 2 for k in range(3)})
    want = []
    for i, r in raws:
        gone = bytearray(len(r))
        if len(r) >= 50_000:
            gone[:] = b"\x01" * len(r)
        else:
            for k in range(len(r) - 199):
                if seen[r[k:k + 200]] > 1:
                    gone[k:k + 200] = b"\x01" * 200
        runs = len(re.findall(b"\x01+", bytes(gone)))
        kept = bytes(b for b, g in zip(r, gone) if not g)
        want.append(((i is None, i or 0), len(r), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    assert by_id(results["op10_repeated_substrings"], "n_bytes", "n_removed", "n_spans",
                 "kept_sha256") == sorted(want)


def test_op7_finds_reparameterised_questions(spark):
    """Numbers, units and names planted in every benchmark item and replaced one to one in a
    copy inside other text: the recall is at least 0.9."""
    from martkit.llm import decontaminate
    texts = {r["item_id"]: r["text"].split() for r in spark.read.parquet(
        "/root/testdata/sf0.01/benchmark.parquet").collect()}

    def planted(words, number, unit, name):
        out = list(words)
        for k in range(len(out) // 10 * 10, 0, -10):
            out[k:k] = [str(number + k), unit, "for", name]
        return " ".join(out)

    bench = spark.createDataFrame([(str(i), planted(w, 12, "kg", "Berlin")) for i, w in texts.items()],
                                  "item_id string, text string")
    docs = [(i, "some words before it. " + planted(w, 317, "miles", "Oslo") + " and some after.")
            for i, w in texts.items()]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = decontaminate.find_leaks(df, bench).collect()
    hit = sum(str(r["doc_id"]) in {x["item"] for x in r["leaks"]} for r in found)
    assert hit >= 0.9 * len(docs), (hit, len(docs))
    assert all(x["changed_slots"] > 0 for r in found for x in r["leaks"])
    clean = spark.createDataFrame([(i, f"plain words {i} of another kind altogether, nothing to see")
                                   for i in range(50)], "doc_id long, text string")
    assert all(not r["leaks"] for r in decontaminate.find_leaks(clean, bench).collect())
