"""Personal data: detection, and sanitisation of the terms that give it away.

Base spans (e-mail, IP, card and phone numbers) are found by pattern and check.
Each distinct value is a protected entity. All terms of the texts that hold an
entity are judged by the corpus: with document frequencies over distinct texts, the pointwise mutual
information of term and entity, log2(N·df(t,e) / (df(t)·df(e))), is the share
of the entity's information content log2(N / df(e)) that the term discloses. A
pair that stands together in less than MIN_SUPPORT texts is judged too, but each
text it is short of counts as one more that holds the term without the entity.
A term that discloses enough of an entity of its text is generalised to its
class wherever it stands there, and removed if it discloses nearly all of it.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.cache import reliable_checkpoint
from .common import add_columns, quoted, table, text_key, text_of
from .repeats import bitmap_of, filtered, node_long

KINDS = ("email", "ip", "card", "phone")
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
NUMBERS = re.compile(r"[0-9]++(?:\.[0-9]++)*+")  # possessive: linear on unbroken digits
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TERM = re.compile(r"[^\W\d_]{2,}")

MIN_SUPPORT = 3    # distinct texts with term and entity from which the frequencies are taken as they are
GENERALISE = 0.8   # disclosed share from which a term is generalised
REMOVE = 0.98      # and from which it is removed


def luhn(digits: str) -> bool:
    total = 0
    for i, ch in enumerate(reversed(digits)):
        d = int(ch)
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _emails(text: str):
    """Leftmost non-overlapping e-mails; the search starts only near an @."""
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and (text[start - 1].isascii()
                                and (text[start - 1].isalnum() or text[start - 1] in "._%+-")):
            start -= 1
        m = EMAIL.match(text, start) if start < at else None
        if m:
            yield m.start(), m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def _ips(text: str):
    """Leftmost non-overlapping groups of four numbers between dots, each at most 255."""
    for m in NUMBERS.finditer(text):
        if m.group().count(".") < 3:
            continue
        parts, at = m.group().split("."), m.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i:i + 4]
            end = at + sum(map(len, four)) + 3
            small = [p.lstrip("0") or "0" for p in four]
            if all(len(p) <= 3 and int(p) <= 255 for p in small):
                yield at, end
            at = end + 1


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind, then start; code points, end exclusive."""
    out = [("email", s, e) for s, e in _emails(text)]
    if not _HAS_DIGITS.search(text):
        return out
    out += [("ip", s, e) for s, e in _ips(text)]
    for m in CARD.finditer(text):
        digits = re.sub(r"[\x20-]", "", m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    for m in PHONE.finditer(text):
        if 8 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


_HAS_DIGITS = re.compile(r"[0-9]")


def entity(kind: str, value: str) -> str:
    """The protected value behind a span, however it is written."""
    if kind in ("card", "phone"):
        value = re.sub(r"[^0-9]", "", value)
    return f"{kind}:{value.lower()}"


def free_terms(text: str):
    """(term, start, end) of the terms that touch no base span."""
    starts, ends = [], []
    for s, e in sorted((s, e) for _, s, e in base_spans(text)):
        if ends and s < ends[-1]:
            ends[-1] = max(ends[-1], e)
        else:
            starts.append(s)
            ends.append(e)
    for m in TERM.finditer(text):
        i = bisect_right(ends, m.start())
        if i == len(ends) or m.end() <= starts[i]:
            yield m.group().lower(), m.start(), m.end()


def term_hash(term: str) -> int:
    return int.from_bytes(hashlib.blake2b(term.encode(), digest_size=8).digest(), "little",
                          signed=True)


BASE = "base array<struct<kind:string,start:long,end:long>>"
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def detect(df: DataFrame, text: str = "text", *, keep: Sequence[str] | None = None) -> DataFrame:
    """Append ``base``: the base spans of each whole text (null and empty: none)."""
    def make():
        def work(texts: pa.Array):
            return [pa.array([[dict(zip(("kind", "start", "end"), s))
                               for s in base_spans(t.as_py())] for t in texts], _SPANS)]

        return work

    return add_columns(df, text, BASE, make, keep)


def found_in(df: DataFrame, text: str = "text", *, keep: Sequence[str] = ()) -> DataFrame:
    """``keep``, ``key`` (content), ``base``, ``entities`` and ``held``: one look at every text.

    ``held`` is the text itself where it holds an entity, else null. The result is
    written to the checkpoint folder, since several steps read it.
    """
    keyed = df.select(*[F.col(quoted(c)) for c in keep], text_of(text).alias("t")).withColumn(
        "key", text_key(F.col("t")))

    def make():
        def work(texts: pa.Array):
            base, who, held = [], [], []
            for t in texts:
                t = t.as_py()
                spans = base_spans(t)
                base.append([dict(zip(("kind", "start", "end"), s)) for s in spans])
                who.append(sorted({entity(k, t[s:e]) for k, s, e in spans}))
                held.append(t if spans else None)
            return [pa.array(base, _SPANS), pa.array(who, pa.list_(pa.string())),
                    pa.array(held, pa.string())]

        return work

    return reliable_checkpoint(add_columns(
        keyed, "t", f"{BASE}, entities array<string>, held string", make, [*keep, "key"]))


def _holders(found: DataFrame) -> DataFrame:
    """(key, t, entities) of all distinct texts that hold an entity, once each."""
    return (found.filter(F.size("entities") > 0).groupBy("key")
            .agg(F.first("held").alias("t"), F.first("entities").alias("entities")))


def _bitmap(terms: DataFrame):
    """A broadcast bitmap of the terms' hashes (column ``h``), sized by their number."""
    return terms.sparkSession.sparkContext.broadcast(bitmap_of(terms, F.col("h")))


def _hashes(texts: DataFrame, keep: Sequence[str], asked=None) -> DataFrame:
    """``keep`` and ``hs``, the hashes of the distinct terms that each text holds anywhere.

    With ``asked`` (a bitmap) texts send only terms that may be asked for; what
    else passes it drops out of the join with the asked terms. Texts without
    such a term have no row.
    """
    def make():
        bitmap = asked.value if asked else None
        bits = 8 * len(bitmap) if asked else 1
        known: dict[str, int | None] = {}

        def wanted(word: str) -> int | None:
            h = term_hash(word)
            p = h % bits
            if len(known) >= 1 << 19:
                known.clear()
            known[word] = h = h if bitmap is None or bitmap[p >> 3] >> (p & 7) & 1 else None
            return h

        def work(texts: pa.Array):
            out = []
            for t in texts:
                found = set()
                for w in {w.lower() for w in set(TERM.findall(t.as_py()))}:
                    h = known[w] if w in known else wanted(w)
                    if h is not None:
                        found.add(h)
                out.append(sorted(found))
            return [pa.array(out, pa.list_(pa.int64()))]

        return work

    return add_columns(texts, "t", "hs array<long>", make, keep).filter(F.size("hs") > 0)


def _term_counts(keyed: DataFrame, terms: DataFrame) -> DataFrame:
    """``terms`` (by hash ``h``) with df_t: the distinct texts that hold each anywhere."""
    held = _hashes(keyed, ["key"], _bitmap(terms))
    counts = (held.groupBy("key").agg(F.first("hs").alias("hs"))
              .select(F.explode("hs").alias("h")).groupBy("h").agg(F.count("*").alias("df_t")))
    return terms.join(counts, "h")


def disclosing_terms(df: DataFrame, text: str = "text", *, min_support: int = MIN_SUPPORT,
                     generalise: float = GENERALISE, remove: float = REMOVE,
                     found: DataFrame | None = None) -> DataFrame:
    """(key, start, end, action) of the terms to sanitise, by the text's content key.

    ``action`` is ``generalise`` or ``remove``. Frequencies are taken over all
    distinct texts, so copies are no evidence. Each text that a pair is short of
    ``min_support`` adds one to the term's frequency: one text of a small corpus
    is little evidence, one of a large corpus is more. Texts without an entity
    have no rows.

    A term in more than ``room`` texts cannot disclose ``generalise`` of an
    entity even if it stands in all of the entity's texts; such pairs are left
    out before they are formed. Entities of the same texts are judged as one.
    ``found`` is what ``found_in`` gave for ``df``, if that is known already.
    """
    keyed = df.select(text_of(text).alias("t")).withColumn("key", text_key(F.col("t")))
    held = reliable_checkpoint(_holders(found_in(df, text) if found is None else found))
    texts = F.lit(float(max(keyed.select("key").distinct().count(), 1)))
    room = (F.pow("df_e", F.lit(generalise)) * F.pow(texts, F.lit(1 - generalise)) * (1 + 1e-9)
            - F.greatest(F.lit(0), F.lit(min_support) - F.col("df_e")))
    named = held.select("key", F.explode("entities").alias("entity"))
    sets = (named.groupBy("entity")
            .agg(F.count("*").alias("df_e"), F.bit_xor(F.xxhash64("key")).alias("x"),
                 F.bit_xor(F.xxhash64("key", F.lit(1))).alias("y"))
            .withColumn("room", room))
    who = reliable_checkpoint(
        named.join(sets, "entity").select("key", "df_e", "x", "y", "room").distinct())
    most = who.groupBy("key").agg(F.max("room").alias("room"))
    asked = (_hashes(held, ["key"]).join(most, "key").select("room", F.explode("hs").alias("h"))
             .groupBy("h").agg(F.count("*").alias("df_held"), F.max("room").alias("room"))
             .filter(F.col("df_held") <= F.col("room")))
    rare = reliable_checkpoint(_term_counts(keyed, reliable_checkpoint(asked.select("h", "room")))
                               .filter(F.col("df_t") <= F.col("room")).select("h", "df_t"))
    near = reliable_checkpoint(
        _hashes(held, ["key"], _bitmap(rare)).select("key", F.explode("hs").alias("h"))
        .join(rare, "h").join(who, "key").filter(F.col("df_t") <= F.col("room"))
        .select("key", "h", "df_t", "df_e", "x", "y"))
    pair = ["h", "df_t", "df_e", "x", "y"]
    holding = F.col("df_t") + F.greatest(F.lit(0), F.lit(min_support) - F.col("df_et"))
    information = F.log2(texts / F.col("df_e"))
    mutual = F.log2(texts * F.col("df_et") / (F.col("df_e") * holding))
    flagged = (near.groupBy(*pair).agg(F.count("*").alias("df_et"))
               .withColumn("share", F.when(information > 0, mutual / information).otherwise(0.0))
               .filter(F.col("share") >= generalise).drop("df_et"))
    terms = (near.join(flagged, pair).groupBy("key", "h").agg(F.max("share").alias("share"))
             .groupBy("key").agg(F.collect_list(F.struct("h", (F.col("share") >= remove).alias(
                 "gone"))).alias("terms")))

    @F.arrow_udf("array<struct<start:long,end:long,action:string>>")
    def places(texts: pa.Array, found: pa.Array) -> pa.Array:
        out = []
        for t, terms in zip(texts.to_pylist(), found.to_pylist()):
            gone = {x["h"]: x["gone"] for x in terms}
            spans = [(gone.get(term_hash(w)), s, e) for w, s, e in free_terms(t)]
            out.append([{"start": s, "end": e, "action": "remove" if g else "generalise"}
                        for g, s, e in spans if g is not None])
        return pa.array(out, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()),
                                                 ("action", pa.string())])))

    return (held.select("key", "t").join(terms, "key")
            .select("key", F.explode(places("t", "terms")).alias("s")).select("key", "s.*"))


def _with_terms(rows: DataFrame, held: Column, terms: DataFrame) -> DataFrame:
    """``rows`` (with ``key``) and the term spans of their text as ``terms``, sorted.

    Only rows for which ``held`` is true can have terms; the others, a text with
    very many copies among them, are not moved.
    """
    spans = terms.groupBy("key").agg(
        F.array_sort(F.collect_list(F.struct("start", "end", "action"))).alias("terms"))
    none = F.lit(None).cast("array<struct<start:bigint,end:bigint,action:string>>").alias("terms")
    # on two fresh exchanges, so that Spark can split a key with very many rows
    joined = rows.filter(held).join(reliable_checkpoint(spans), "key", "left")
    return joined.unionByName(rows.filter(~held).select("*", none))


def sanitise(df: DataFrame, text: str = "text", **thresholds) -> DataFrame:
    """The rows with their text sanitised, all columns kept, in a frame of the same columns.

    Base spans become ``<EMAIL>``, ``<IP>``, ``<CARD>`` or ``<PHONE>``;
    disclosing terms become ``<NAME>`` (capitalised) or ``<TERM>``, or vanish.
    Overlapping spans are replaced once. A null text stays null; texts without
    spans stay as they are.
    """
    cols = df.columns
    found = found_in(df, text)
    terms = disclosing_terms(df, text, found=found, **thresholds)
    row = F.struct(*[F.col(quoted(c)) for c in cols]).alias("row")
    rows = df.select(row, text_key(text_of(text)).alias("key"))
    who = found.filter(F.size("entities") > 0).select("key").distinct()
    marked = filtered(rows, bitmap_of(who, node_long("key")), "key", flag="__llm_may")
    joined = _with_terms(marked, F.col("__llm_may"), terms).select(
        "row", F.col(f"row.{quoted(text)}").alias("t"), "terms", "__llm_may")

    @F.arrow_udf("string")
    def clean(texts: pa.Array, found: pa.Array) -> pa.Array:
        out = []
        for t, extra in zip(texts.to_pylist(), found.to_pylist()):
            if t is None:
                out.append(None)
                continue
            spans = [(s, e, f"<{k.upper()}>") for k, s, e in base_spans(t)]
            for x in extra or []:
                s, e = x["start"], x["end"]
                label = "<NAME>" if t[s].isupper() else "<TERM>"
                spans.append((s, e, label if x["action"] == "generalise" else ""))
            parts, done = [], 0
            for s, e, label in sorted(spans):
                if s >= done:
                    parts += [t[done:s], label]
                done = max(done, e)
            out.append("".join([*parts, t[done:]]))
        return pa.array(out, pa.string())

    # texts that hold no entity stay as they are and do not go to Python
    done = joined.filter("__llm_may").withColumn("__llm_clean", clean("t", "terms")).unionByName(
        joined.filter(~F.col("__llm_may")).withColumn("__llm_clean", F.col("t")))
    return done.select(*[F.col("__llm_clean").alias(c) if c == text
                         else F.col(f"row.{quoted(c)}").alias(c) for c in cols])


def op2_pii(spark, sf_dir: str) -> DataFrame:
    """Base spans of every document, and all spans with the disclosing terms."""
    docs = table(spark, sf_dir, "documents")
    found = found_in(docs, keep=["doc_id"])
    terms = disclosing_terms(docs, found=found)
    rows = _with_terms(found.select("doc_id", "key", "base"), F.size("base") > 0, terms)
    listed = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    extra = F.coalesce(F.array_join(F.transform("terms", lambda s: F.concat_ws(
        ":", F.lit("term"), s["start"].cast("string"), s["end"].cast("string"))), ","), F.lit(""))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return rows.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        F.concat_ws(",", *[F.when(x != "", x) for x in (listed(F.col("base")), extra)])
        .alias("spans"),
        F.coalesce(F.size("terms"), F.lit(0)).cast("long").alias("n_terms"))
