"""Quality classifier: Bradley-Terry ranking of documents.

A document's strength is a linear score of features of its text. It is learned
from preference pairs (a good document over a bad one): the probability that
one wins is the logistic function of the strength difference, so the fit is a
logistic regression without intercept on feature differences. The threshold is
a quantile of the strengths of the labelled documents: the share of bad ones.

Every labelled document takes part. The rows are dealt into blocks by a hash, each
draws its opponents in its block, and a Newton step adds up the blocks' sums, which
are all that reaches the driver.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.cache import reliable_checkpoint
from .common import TEXT, add_columns, others, quoted, table, text_key, text_of
from .language import held_out
from .repeats import grouped

PAIRS_PER_ROW = 8      # opponents of each labelled row
BLOCK_ROWS = 2048      # expected labelled rows of a block, in which opponents are drawn
BLOCK_RARER = 64       # expected rows of the rarer class in a block; fewer are copied to more blocks
ROUNDS = 30            # Newton steps at most
BINS = 4096            # of a step towards an order statistic
UNIT = 1 << 20         # sums of blocks are whole multiples of 1 / UNIT, so their order does not count
RIDGE = 1e-3
CUT_SCORE = 0.7        # a score at the threshold

_SYMBOL = re.compile(r"[^\w\s.,;:'\"!?()\-]")


def repeats(words: Sequence[str]) -> int:
    """Stretches of at least three equal words; the first may be the end of a longer word."""
    found, at, m, hit = 0, 0, len(words), False
    while at < m:
        end = at + 1
        while end < m and words[end] == words[at]:
            end += 1
        before = at > 0 and not hit and words[at - 1].endswith(words[at])
        hit = end - at + before >= 3
        found += hit
        at = end
    return found


def features(text: str) -> list[float]:
    """Ratios that describe a text's form; all are defined for empty texts."""
    n = len(text)
    words = text.split()
    m = len(words)
    if not m:
        return [1.0] + [0.0] * 15
    lines = [x for x in text.split("\n") if x.strip()]
    counts = Counter(words)
    line_counts = Counter(lines)
    top = counts.most_common(1)[0][1]
    same = sum(a == b for a, b in zip(words, words[1:]))
    upper = sum(w.isupper() and len(w) > 1 for w in words)
    symbols = len(_SYMBOL.findall(text))
    raw = text.encode()
    alone = sum(len(w) == 1 and not w.isalnum() for w in words)
    marks = sum(not w[-1].isalnum() and w[-1] not in ".,;:)\"'" for w in words)
    return [
        0.0,
        upper / m,
        symbols / n,
        alone / m,
        marks / m,
        same / max(1, m - 1),
        top / m,
        1 - len(counts) / m,
        1 - len(line_counts) / len(lines),
        sum(ch.isdigit() for ch in text) / n,
        text.count("!") / n,
        sum(map(len, words)) / m / 10,
        min(1.0, len(zlib.compress(raw, 1)) / len(raw)),
        repeats(words) / m,
        float(np.log1p(m)) / 10,
        sum(w[-1] in ".!?" for w in words) / m,
    ]


@dataclass(frozen=True)
class Ranker:
    """Strength = weights · (features - centre) / scale; ``cut`` is the threshold."""

    weights: tuple[float, ...]
    centre: tuple[float, ...]
    scale: tuple[float, ...]
    cut: float

    def strengths(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - np.array(self.centre)) / np.array(self.scale), -8, 8)
        return np.sum(z * np.array(self.weights), axis=1)  # row by row, batch-independent

    def scores(self, x: np.ndarray) -> np.ndarray:
        """A monotone map of the strength into (0, 1) with the threshold at CUT_SCORE."""
        logit = np.log(CUT_SCORE / (1 - CUT_SCORE))
        return 1 / (1 + np.exp(-np.clip(self.strengths(x) - self.cut + logit, -30, 30)))


def pair_sums(z: np.ndarray, good: np.ndarray, own: np.ndarray, w: np.ndarray, seed: int,
              per_row: int = PAIRS_PER_ROW) -> np.ndarray:
    """Pairs, logistic loss, its gradient and its Hessian at ``w``, summed over a block's pairs.

    Each of the block's own rows meets ``per_row`` rows of the other class; the
    rows that are not its own are there as opponents only.
    """
    k = len(w)
    wins, losses = np.flatnonzero(good), np.flatnonzero(~good)
    if not len(wins) or not len(losses):
        return np.zeros(2 + k + k * k)
    rng = np.random.default_rng([7, seed])
    up, down = np.repeat(wins[own[wins]], per_row), np.repeat(losses[own[losses]], per_row)
    a = np.concatenate([up, rng.choice(wins, len(down))])
    b = np.concatenate([rng.choice(losses, len(up)), down])
    d = z[a] - z[b]
    m = d @ w
    p = 1 / (1 + np.exp(np.clip(m, -30, 30)))
    hess = (d * (p * (1 - p))[:, None]).T @ d
    return np.concatenate([[len(d), np.logaddexp(0, -m).sum()], -(d.T @ p), hess.ravel()])


def fit_pairs(sums: Callable[[np.ndarray], np.ndarray], k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Bradley-Terry weights by Newton steps; ``sums`` gives ``pair_sums`` of all blocks."""
    def at(w):
        total = sums(w)
        n = max(total[0], 1)
        return (total[1] / n + RIDGE / 2 * w @ w, total[2:2 + k] / n + RIDGE * w,
                total[2 + k:].reshape(k, k) / n + RIDGE * np.eye(k))

    w = np.zeros(k)
    now, grad, hess = at(w)
    for _ in range(rounds):
        step, rate = np.linalg.solve(hess, grad), 1.0
        new = at(w - step)
        while rate > 1e-4 and new[0] > now:
            rate /= 2
            new = at(w - rate * step)
        w, gain = w - rate * step, now - new[0]
        now, grad, hess = new
        if gain < 1e-9:
            break
    return w


def _blocks(rows: DataFrame, n: int, rarer: int, rarer_good: bool) -> DataFrame:
    """``rows`` (h, good, x) with ``block`` and ``own``, dealt and sorted by the block.

    Rows of a rarer class that has too few for all blocks are copied to several;
    they are ``own`` rows of one.
    """
    blocks = -(-n // BLOCK_ROWS)
    copies = min(blocks, -(-BLOCK_RARER * blocks // rarer))
    times = F.when(F.col("good") == rarer_good, F.lit(copies)).otherwise(F.lit(1))
    spread = rows.withColumn("copy", F.explode(F.sequence(F.lit(0), times - 1))).select(
        F.pmod(F.pmod("h", F.lit(blocks)) + F.col("copy") * (blocks // copies), F.lit(blocks))
        .alias("block"), (F.col("copy") == 0).alias("own"), "h", "good", "x")
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return spread.repartition(min(width, blocks), "block").sortWithinPartitions("block")


def _block_sums(blocks: DataFrame, centre: np.ndarray, scale: np.ndarray, w: np.ndarray
                ) -> np.ndarray:
    """``pair_sums`` of all blocks together."""
    def work(batch: pa.RecordBatch, starts: np.ndarray) -> list[pa.RecordBatch]:
        x = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, -1)
        z = np.clip((x - centre) / scale, -8, 8)
        good, own, h, block = (batch.column(c).to_numpy(zero_copy_only=False)
                               for c in ("good", "own", "h", "block"))
        total = np.zeros(2 + len(w) + len(w) ** 2, dtype=np.int64)
        for lo, hi in zip(starts.tolist(), [*starts[1:].tolist(), batch.num_rows]):
            order = lo + np.lexsort((*z[lo:hi].T, good[lo:hi], own[lo:hi], h[lo:hi]))
            part = pair_sums(z[order], good[order], own[order], w, int(block[lo]))
            total += np.rint(part * UNIT).astype(np.int64)
        return [pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], names=["i", "v"])]

    got = (grouped(blocks, "block", "i int, v long", work, dealt=True)
           .groupBy("i").agg(F.sum("v").alias("v")).collect())
    return np.array([r["v"] for r in sorted(got)], dtype=np.float64) / UNIT


def at_rank(values: DataFrame, k: int) -> float:
    """The k-th smallest (from 0) of the column ``s``, by counts of ever finer bins."""
    low, high = values.agg(F.min("s"), F.max("s")).first()
    while low < high:
        place = F.least(F.floor((F.col("s") - low) * (BINS / (high - low))), F.lit(BINS - 1))
        bins = (values.filter(F.col("s").between(low, high)).groupBy(place.alias("bin"))
                .agg(F.count("*").alias("n"), F.min("s").alias("low"), F.max("s").alias("high"))
                .collect())
        for b in sorted(bins):
            if k < b["n"]:
                break
            k -= b["n"]
        low, high = b["low"], b["high"]
    return low


def learn(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
          label: str = "quality", described: bool = False) -> Ranker:
    """Fit the ranking on all labelled documents.

    Rows with a null id or label are not used; ids labelled both ways keep both
    rows, repeated label rows and repeated documents count once. ``described``
    documents come from ``describe`` with their ids. Only feature vectors are joined
    with the labels and move; sums over blocks and counts reach the driver. Without
    rows of both classes every strength is 0 and every score ``CUT_SCORE``.
    """
    k = len(features(""))
    marks = labels.select(F.col(quoted(doc_id)).alias("id"),
                          (F.col(quoted(label)).cast("int") == 1).alias("good")).dropna().distinct()
    known = docs if described else describe(docs, text, keep=[doc_id])
    rows = reliable_checkpoint(
        known.select(F.col(quoted(doc_id)).alias("id"), "key", "x").join(marks, "id")
        .dropDuplicates(["id", "key", "good"])
        .select(F.xxhash64("id", "key").alias("h"), "good", "x"))
    exact = "decimal(38,12)"  # exact sums, whatever their order
    got = rows.agg(F.count("*"), F.count_if("good"), *[
        F.sum((F.col("x")[i] ** p).cast(exact)) for p in (1, 2) for i in range(k)]).first()
    n, good = got[0], got[1]
    if not 0 < good < n:
        return Ranker((0.0,) * k, (0.0,) * k, (1.0,) * k, 0.0)
    centre, squares = (np.array([float(v / n) for v in got[at:at + k]]) for at in (2, 2 + k))
    scale = np.maximum(np.sqrt(np.maximum(squares - centre ** 2, 0)), 1e-3)
    blocks = reliable_checkpoint(_blocks(rows, n, min(good, n - good), good <= n - good))
    w = fit_pairs(lambda w: _block_sums(blocks, centre, scale, w), k)
    ranker = Ranker(tuple(w.tolist()), tuple(centre.tolist()), tuple(scale.tolist()), 0.0)

    def strengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, -1)
            yield pa.RecordBatch.from_arrays([pa.array(ranker.strengths(x))], names=["s"])

    s = reliable_checkpoint(rows.select("x").mapInArrow(strengths, "s double"))
    at = (n - good) / n * (n - 1)
    low, high = at_rank(s, int(at)), at_rank(s, min(int(at) + 1, n - 1))
    return Ranker(ranker.weights, ranker.centre, ranker.scale, low + (high - low) * (at - int(at)))


def describe(df: DataFrame, text: str = "text", *, keep: Sequence[str] | None = None) -> DataFrame:
    """Append ``key``, the text's content key, and ``x``, its features."""
    kept = [c for c in (df.columns if keep is None else keep) if c in others(df, "key", "x")]
    return add_columns(df.select(*[F.col(quoted(c)) for c in kept], text_of(text).alias(TEXT))
                       .withColumn("key", text_key(F.col(TEXT))), TEXT, "x array<double>",
                       _feature_arrays, [*kept, "key"])


def _feature_arrays():
    def work(texts: pa.Array):
        return [pa.array([features(t.as_py()) for t in texts], pa.list_(pa.float64()))]

    return work


def rate(df: DataFrame, ranker: Ranker, text: str = "text", *, described: bool = False,
         keep: Sequence[str] | None = None) -> DataFrame:
    """Append ``score`` (0 to 1) and ``predicted`` (1 from CUT_SCORE on).

    Null and empty texts are scored like any other; equal texts score equally.
    ``described`` rows come from ``describe``; their features are not computed again.
    """
    outputs = "score double, predicted int"

    def scored(x: np.ndarray):
        s = ranker.scores(x) if len(x) else np.zeros(0)
        return [pa.array(s, pa.float64()), pa.array((s >= CUT_SCORE).astype(np.int32), pa.int32())]

    def make():
        return lambda texts: scored(
            np.array([features(t.as_py()) for t in texts]).reshape(len(texts), -1))

    if not described:
        return add_columns(df, text, outputs, make, keep)
    kept = others(df, "key", "x", "score", "predicted") if keep is None else list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, -1)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), *scored(x)], names=[*kept, "score", "predicted"])

    rows = df.select(*[F.col(quoted(c)) for c in kept], "x")
    schema = df.select(*[F.col(quoted(c)) for c in kept]).schema
    return rows.mapInArrow(run, schema.add("score", "double").add("predicted", "integer"))


def op4_quality(spark, sf_dir: str) -> DataFrame:
    """Scores of all documents, learned from labels of rows that are not held out.

    Features are computed once for all documents, and stored for the fit and the scores.
    """
    docs = table(spark, sf_dir, "documents").withColumn("held_out", held_out())
    labels = table(spark, sf_dir, "labels")
    rows = reliable_checkpoint(describe(docs, keep=["doc_id", "held_out"]))
    ranker = learn(rows.filter("not held_out"), labels.filter(~held_out()), described=True)
    out = rate(rows, ranker, described=True, keep=["doc_id", "held_out"])
    return out.select("doc_id", "held_out", "score", "predicted")
