"""Shared pieces of the training-data operators: Arrow mapping, keys, word hashes.

Conventions every operator keeps:

* A null text counts as an empty one unless the operator says otherwise.
* Input columns that clash (case-insensitively) with an operator's output
  columns are dropped in favour of the output; all others are carried along.
* Texts are processed whole, row by row or in Arrow batches; nothing is sent
  to the driver except values whose size a documented parameter bounds.
"""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TEXT = "__llm_text"
SLICE = 1 << 20  # bytes of text whose rows leave a task at once


def workers_path(spark: SparkSession) -> None:
    """Let Python workers find this package.

    Workers of a local session find it wherever the driver found it; on a cluster it is
    installed or passed with --py-files, and the extra path is harmless. An executor
    starts a daemon and workers of its own for each environment that functions come
    with, and keeps them: a session sets it before its first function.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [env.get("PYTHONPATH"), root]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables."""
    workers_path(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files that nothing refers to any more.

    Spark's cleaner deletes the files of a step once the driver has collected
    the step's objects, which it otherwise does only when its heap fills; on a
    small driver's heap the files of all steps would stay until the end. Called
    after checkpoints that cut the lineage of large steps.
    """
    spark.sparkContext._jvm.System.gc()


def give_back() -> None:
    """Return the process's freed memory to the system, as far as the allocators can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def in_arrow(rows: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
             schema: str | T.StructType) -> DataFrame:
    """``rows.mapInArrow``, after which a worker gives back what it has freed.

    An executor keeps idle workers, and each would stay as large as its largest task.
    """
    def freed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return rows.mapInArrow(freed, schema)


def no_rows(spark: SparkSession, schema: str) -> DataFrame:
    """An empty frame of a DDL schema that Spark plans away.

    ``createDataFrame`` makes one by an RDD, whose tasks start Python workers of
    another kind on every executor, which keeps them beside the others.
    """
    fields = T.StructType.fromDDL(schema).fields
    return spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields]
                                 ).filter(F.lit(False))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def others(df: DataFrame, *taken: str) -> list[str]:
    """Columns of ``df`` that do not clash with the ``taken`` names."""
    low = {t.lower() for t in taken}
    return [c for c in df.columns if c.lower() not in low]


def text_of(name: str) -> Column:
    """The text column with null read as the empty text."""
    return F.coalesce(F.col(quoted(name)).cast("string"), F.lit(""))


def text_key(text: Column) -> Column:
    """16-byte content key of a text; equal texts have equal keys."""
    return F.unhex(F.md5(text.cast("binary")))


def add_columns(df: DataFrame, text: str, outputs: str,
                make: Callable[[], Callable[[pa.Array], Sequence[pa.Array]]],
                keep: Sequence[str] | None = None) -> DataFrame:
    """Append ``outputs`` (a DDL string) computed from the text column.

    ``make`` runs once per task and returns a function from an Arrow array of
    texts (never null) to one Arrow array per output. ``keep`` names the input
    columns to carry along (default: all that do not clash). A text that is kept
    goes to the worker once, and rows leave in slices of about SLICE bytes of text.
    """
    out = T.StructType.fromDDL(outputs)
    names = [f.name for f in out.fields]
    kept = [c for c in (df.columns if keep is None else keep) if c in others(df, *names)]
    once = text in kept and isinstance(df.schema[text].dataType, T.StringType)
    at = kept.index(text) if once else len(kept)
    rows = df.select(*[F.col(quoted(c)) for c in kept],
                     *([] if once else [text_of(text).alias(TEXT)]))
    schema = T.StructType([*(rows.schema[c] for c in kept), *out.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            texts = pc.fill_null(batch.column(at), "")
            for lo, hi in text_slices(raw_bytes(texts)[1], SLICE):
                part = batch.slice(lo, hi - lo)
                new = work(texts.slice(lo, hi - lo))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i) for i in range(len(kept))), *new], names=[*kept, *names])

    return in_arrow(rows, run, schema)


# --- vectorised words and shingles ------------------------------------------

SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it is invertible modulo 2^64
_BASE_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: bijective, every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


class Powers:
    """Cached powers of the rolling base and of its inverse."""

    def __init__(self) -> None:
        self.up = self.down = np.zeros(0, dtype=np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            m = max(n, 1 << 16)
            self.up, self.down = _powers(_BASE, m), _powers(_BASE_INV, m)
        return self.up[:n], self.down[:n]


POWERS = Powers()


def raw_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array back to back, and the n+1 offsets."""
    texts = texts.cast(pa.large_string()) if not pa.types.is_large_string(texts.type) else texts
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + n + 1]
    data = texts.buffers()[2]
    whole = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, np.uint8)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    return whole[offsets[0]:offsets[-1]], offsets - offsets[0]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Prefix sums of byte·base^i modulo 2^64 (length n + 1)."""
    up, _ = POWERS.get(len(data))
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up, out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Position-free 64-bit hash of each span; equal strings hash equally."""
    _, down = POWERS.get(len(prefix))
    raw = (prefix[ends] - prefix[starts]) * down[starts]
    return mix64(raw + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_spans(data: np.ndarray, offsets: np.ndarray, spaces: np.ndarray = SPACES
               ) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word (maximal run of non-space bytes inside one text)."""
    solid = ~spaces[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    inner = offsets[1:-1]
    edge[inner] = True  # words never cross texts
    before = np.zeros(len(data), dtype=bool)
    before[1:] = solid[:-1]
    before &= ~edge[:-1]
    after = np.zeros(len(data), dtype=bool)
    after[:-1] = solid[1:]
    after &= ~edge[1:]
    return np.flatnonzero(solid & ~before), np.flatnonzero(solid & ~after) + 1


def lower_bytes(data: np.ndarray) -> np.ndarray:
    """A-Z lower-cased; every other byte as it is."""
    return _LOWER[data]


def window_hash(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` consecutive word hashes."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    acc = np.zeros(n, dtype=np.uint64)
    for k in range(width):
        acc = acc * np.uint64(0xC2B2AE3D27D4EB4F) + words[k:k + n]
    return mix64(acc)


def text_slices(offsets: np.ndarray, limit: int = 1 << 19) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes each: bounded memory, and arrays that fit the cache."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi
        lo = hi
