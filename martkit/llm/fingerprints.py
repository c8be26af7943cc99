"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash over seven bytes is evaluated at every byte; where it hits the
trigger of the block size a chunk ends, and each chunk adds one character of
its hash to the signature. Edits change only the chunks they touch. The block
size follows the text's length, and the signature is kept for that size and
for twice that size, so texts of like length stay comparable. Two fingerprints
are compared by the edit distance of signatures at a common block size.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import add_columns, table, text_of

WINDOW = 7
MIN_BLOCK = 3
SIGNATURE = 64   # characters a signature is sized for
LONGEST = 1024   # and has at most: on periodic bytes every piece may trigger; the last takes the rest
GRAM = 7         # two signatures without a common run of so many characters are unlike
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
_STEP = 1 << 20


def rolling(data: np.ndarray) -> np.ndarray:
    """Hash of the last seven bytes at every byte (bytes before the text are zero)."""
    padded = np.zeros(len(data) + WINDOW - 1, dtype=np.uint32)
    padded[WINDOW - 1:] = data
    acc = np.zeros(len(data), dtype=np.uint32)
    for k in range(WINDOW):
        acc = acc * np.uint32(0x01000193) + padded[k:k + len(data)]
    acc ^= acc >> np.uint32(15)
    acc *= np.uint32(0x2C1B3C6D)
    acc ^= acc >> np.uint32(13)
    return acc


def triggers(data: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Chunk ends for the block size and for twice the size."""
    ends = []
    for lo in range(0, len(data), _STEP):  # bounded memory on very long texts
        back = max(0, lo - WINDOW + 1)
        h = rolling(data[back:lo + _STEP])[lo - back:]
        at = np.flatnonzero(h % np.uint32(block) == block - 1)
        ends.append((at + lo + 1, h[at]))
    if not ends:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.concatenate([e[0] for e in ends])
    h = np.concatenate([e[1] for e in ends])
    return at, at[h % np.uint32(2 * block) == 2 * block - 1]


def signature(raw: bytes, ends: np.ndarray) -> str:
    """A character for each piece; the last of at most LONGEST pieces takes the rest."""
    out, start = [], 0
    for e in ends[:LONGEST - 1].tolist():
        out.append(ALPHABET[zlib.crc32(raw[start:e]) & 63])
        start = e
    if start < len(raw):
        out.append(ALPHABET[zlib.crc32(raw[start:]) & 63])
    return "".join(out)


def fingerprint_of(raw: bytes) -> str:
    """``block:signature:signature at twice the block`` of the bytes (empty: ``3::``)."""
    block = MIN_BLOCK
    while block * SIGNATURE < len(raw):
        block *= 2
    data = np.frombuffer(raw, dtype=np.uint8)
    while True:
        one, two = triggers(data, block)
        if block == MIN_BLOCK or len(one) >= SIGNATURE // 2:
            return f"{block}:{signature(raw, one)}:{signature(raw, two)}"
        block //= 2


def fingerprint(df: DataFrame, text: str = "text", *, keep: Sequence[str] | None = None
                ) -> DataFrame:
    """Append ``fingerprint`` of each whole text (null: empty; equal texts: equal)."""
    def make():
        def work(texts: pa.Array):
            return [pa.array([fingerprint_of(t.as_py().encode()) for t in texts], pa.string())]

        return work

    return add_columns(df, text, "fingerprint string", make, keep)


def _alike(a: Column, b: Column) -> Column:
    grams = lambda s: F.transform(
        F.sequence(F.lit(1), F.greatest(F.length(s) - GRAM + 1, F.lit(1))),
        lambda i: F.substring(s, i, F.lit(GRAM)))
    longest = F.greatest(F.length(a), F.length(b))
    gate = F.least(F.length(a), F.length(b)) < GRAM
    return F.when(longest == 0, 0.0).when(a == b, 1.0).when(
        ~gate & ~F.arrays_overlap(grams(a), grams(b)), 0.0).otherwise(
        1 - F.levenshtein(a, b) / longest)


def likeness(a: Column, b: Column) -> Column:
    """Likeness of two fingerprints in [0, 1]; 0 if no block size is common, null if one is null.

    The larger likeness counts where both signatures are comparable.
    """
    part = lambda c, i: F.split_part(c, F.lit(":"), F.lit(i))
    size = lambda c: part(c, 1).cast("long")
    return (F.when(a.isNull() | b.isNull(), F.lit(None).cast("double"))
            .when(a == b, 1.0)
            .when(size(a) == size(b),
                  F.greatest(_alike(part(a, 2), part(b, 2)), _alike(part(a, 3), part(b, 3))))
            .when(size(a) == 2 * size(b), _alike(part(a, 2), part(b, 3)))
            .when(2 * size(a) == size(b), _alike(part(a, 3), part(b, 2)))
            .otherwise(0.0))


def neighbours(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (grp, ord, doc_id, t, copy) dealt into ranges of ascending id.

    Every range also holds a copy of the first row of the next non-empty range
    (the last range: of the very first row), so each row finds its successor
    inside its own range. The range bounds are quantiles of the ids; their
    number follows the shuffle width, and the only values that reach the driver
    are these bounds and the first id of each range. Rows with a null id come
    first; ties of an id stand in one range, ordered by text.
    """
    spark = df.sparkSession
    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("t"))
    n = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = rows.agg(F.percentile_approx(
        "doc_id", [i / n for i in range(1, n)], 10 * n)).first()[0] or []
    cuts = sorted(set(cuts))
    bounds = np.array(cuts, dtype=np.int64)

    @F.arrow_udf("int")
    def range_of(ids: pa.Array) -> pa.Array:  # the number of bounds <= id; null ids: range 0
        at = np.searchsorted(bounds, ids.fill_null(-1 << 63).to_numpy(zero_copy_only=False), "right")
        return pa.array(at, pa.int32())

    ranged = rows.withColumn("grp", range_of("doc_id"))
    firsts = sorted((r["grp"], r["nulls"], r["least"]) for r in ranged.groupBy("grp").agg(
        F.min("doc_id").alias("least"), F.max(F.col("doc_id").isNull()).alias("nulls")).collect())
    if not firsts:
        return ranged.select("grp", F.lit(0).alias("ord"), "doc_id", "t", F.lit(False).alias("copy"))
    target = {g: firsts[i - 1][0] for i, (g, _, _) in enumerate(firsts)}  # the range before it
    heads = spark.createDataFrame(
        [(g, None if nulls else least, target[g], 2 if i == 0 else 1)
         for i, (g, nulls, least) in enumerate(firsts)],
        "grp int, head long, target int, ord int")
    copies = (ranged.join(F.broadcast(heads), (ranged["grp"] == heads["grp"])
                          & ranged["doc_id"].eqNullSafe(heads["head"]))
              .select(heads["target"].alias("grp"), "ord", "doc_id", "t", F.lit(True).alias("copy")))
    own = ranged.select("grp", F.lit(0).alias("ord"), "doc_id", "t", F.lit(False).alias("copy"))
    return own.unionByName(copies)


def op5_fingerprints(spark, sf_dir: str) -> DataFrame:
    """Fingerprints of each document and of its edited text, and their likenesses."""
    rows = neighbours(table(spark, sf_dir, "documents"))
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(width, "grp").sortWithinPartitions("grp", "ord", "doc_id", "t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the row that waits for its successor: (grp, doc_id, text, print)
        first_copy = None  # range whose successor is found (ties of the next first id follow)

        def done(out, grp, nxt, nxt_print):
            _, doc_id, t, own = out
            quarter = len(t) // 4
            edited = t[:len(t) - quarter] + nxt[:quarter] if quarter else t
            raw = edited.encode()
            return (doc_id, len(t), hashlib.sha256(raw).hexdigest(), own,
                    own if edited == t else fingerprint_of(raw), nxt_print)

        for batch in batches:
            rows = []
            for grp, copy, doc_id, t in zip(*(batch.column(c) for c in ("grp", "copy", "doc_id", "t"))):
                grp, copy, doc_id, t = grp.as_py(), copy.as_py(), doc_id.as_py(), t.as_py()
                if copy and first_copy == grp:
                    continue
                p = fingerprint_of(t.encode())
                if held is not None and held[0] == grp:
                    rows.append(done(held, grp, t, p))
                held = None if copy else (grp, doc_id, t, p)
                first_copy = grp if copy else None
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(
                    zip(*rows) if rows else [[]] * 6,
                    (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string()))],
                names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                       "next_fingerprint"])

    found = dealt.mapInArrow(
        run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
             "edited_fingerprint string, next_fingerprint string")
    return found.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))
