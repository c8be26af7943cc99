"""Byte-level BPE encoding and decoding by overlapping chunks.

A text is cut into chunks that overlap. Chunks are pre-tokenised independently
(one row each, so the chunks of one long text spread over many tasks). The
pre-token pattern has no look-behind, so two pre-tokenisations that share a
boundary agree from there on: neighbouring chunks are stitched at the first
boundary they share inside their overlap. Only boundaries behind a
non-space character are used, because white space looks ahead. The pieces
between stitches are then encoded in parallel and their ids concatenated.
Decoding concatenates the bytes of the ids.

Where two neighbours share no boundary (one pre-token longer than the
overlap), the text from there on stays one piece, so the ids are always those
of the whole text.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Callable, Sequence

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import TEXT, add_columns, in_arrow, others, quoted, table, text_of

CHUNK = 1 << 16
OVERLAP = 1 << 12
SLICE = 1 << 20  # bytes of ids and digests that leave a task together
LOOKAHEAD = 2  # characters behind a pre-token that the pattern may inspect


@functools.lru_cache(maxsize=2)
def encoding(rank_file: bytes, pattern: str) -> tiktoken.Encoding:
    """The encoder of a rank file's content (cached per worker process)."""
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, rank_file.splitlines()) if a}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@functools.lru_cache(maxsize=2)
def token_bytes(rank_file: bytes) -> dict[int, bytes]:
    return {int(b): base64.b64decode(a) for a, b in map(bytes.split, rank_file.splitlines()) if a}


def read_ranks(path: str | None = None) -> bytes:
    """Content of a rank file (under 1 MB); it travels to the tasks with the plan."""
    with open(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        return f.read()


def boundaries(text: str, pattern: str, lo: int, hi: int, last: bool) -> list[int]:
    """Trusted pre-token ends of ``text`` in [lo, hi] that follow a non-space character."""
    end = len(text) if last else len(text) - LOOKAHEAD
    return [m.end() for m in regex.finditer(pattern, text)
            if lo <= m.end() <= min(hi, end) and not text[m.end() - 1].isspace()]


def cut_points(chunks: Sequence[tuple[int, list[int], list[int]]]) -> list[int]:
    """Stitch positions from (start, head, tail) of a text's chunks in order.

    ``head`` are boundaries in the overlap with the previous chunk, ``tail``
    those in the overlap with the next. The chain ends at the first chunk that
    shares none; the rest of the text stays one piece.
    """
    cuts: list[int] = []
    for (_, _, tail), (_, head, _) in zip(chunks, chunks[1:]):
        shared = sorted(set(tail) & set(head))
        shared = [p for p in shared if not cuts or p > cuts[-1]]
        if not shared:
            break
        cuts.append(shared[0])
    return cuts


def _encode_array(rank_file: bytes, pattern: str) -> Callable[[], Callable]:
    def make():
        enc = encoding(rank_file, pattern)

        def work(texts: pa.Array):
            return [pa.array((enc.encode_to_numpy(t.as_py()).astype("<u4").tobytes()
                              for t in texts), pa.binary())]

        return work

    return make


def _encode_long(long: DataFrame, rank_file: bytes, pattern: str, chunk: int,
                 overlap: int) -> DataFrame:
    """(key, ids) of the distinct texts of ``long`` (key, t)."""
    texts = long.groupBy("key").agg(F.first("t").alias("t"))

    def split(batches):
        for batch in batches:
            for key, t in zip(batch.column(0), batch.column(1)):
                t = t.as_py()
                for start in range(0, len(t), chunk):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([key.as_py()], pa.binary()), pa.array([start], pa.int64()),
                         pa.array([start + chunk + overlap >= len(t)]),
                         pa.array([t[start:start + chunk + overlap]])],
                        names=["key", "start", "last", "t"])

    def pretokenise(batches):
        for batch in batches:
            rows = []
            for key, start, last, t in zip(*(c.to_pylist() for c in batch.columns)):
                rows.append({
                    "key": key, "start": start,
                    "head": [start + p for p in boundaries(t, pattern, 1, overlap, last)]
                    if start else [],
                    "tail": [start + p for p in
                             boundaries(t, pattern, chunk + 1, chunk + overlap, last)]})
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([
                ("key", pa.binary()), ("start", pa.int64()),
                ("head", pa.list_(pa.int64())), ("tail", pa.list_(pa.int64()))]))

    def pieces(batches):
        for batch in batches:
            for key, t, chunks in zip(*(c.to_pylist() for c in batch.columns)):
                ordered = sorted((c["start"], c["head"], c["tail"]) for c in chunks)
                cuts = [0, *cut_points(ordered), len(t)]
                for lo, hi in zip(cuts, cuts[1:]):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([key], pa.binary()), pa.array([lo], pa.int64()),
                         pa.array([t[lo:hi]])], names=["key", "start", "t"])

    def join(batches):
        for batch in batches:
            keys = batch.column(0)
            ids = [b"".join(p["ids"] for p in sorted(parts, key=lambda p: p["start"]))
                   for parts in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([keys, pa.array(ids, pa.binary())],
                                             names=["key", "ids"])

    width = int(long.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = (in_arrow(texts, split, "key binary, start long, last boolean, t string")
              .repartition(width, "key", "start"))
    marks = (in_arrow(spread, pretokenise,
                      "key binary, start long, head array<long>, tail array<long>")
             .groupBy("key").agg(F.collect_list(F.struct("start", "head", "tail")).alias("chunks")))
    cut = (in_arrow(texts.join(marks, "key").select("key", "t", "chunks"), pieces,
                    "key binary, start long, t string")
           .repartition(width, "key", "start"))
    done = add_columns(cut, "t", "ids binary", _encode_array(rank_file, pattern), ["key", "start"])
    return in_arrow(done.groupBy("key").agg(F.collect_list(F.struct("start", "ids")).alias("parts")),
                    join, "key binary, ids binary")


def encode(df: DataFrame, text: str = "text", *, ranks: bytes | None = None,
           pattern: str = public_tokenizers.PATTERN, chunk: int = CHUNK, overlap: int = OVERLAP,
           keep: Sequence[str] | None = None) -> DataFrame:
    """Append ``ids``: the token ids as little-endian unsigned 32-bit integers.

    Null and empty texts give empty ids. A text of up to ``chunk`` characters
    is a single chunk and is encoded where it stands; longer ones are chunked,
    spread and stitched as described above, once per distinct text. Repeated
    rows stay repeated.
    """
    if not 0 < overlap <= chunk:
        raise ValueError("need 0 < overlap <= chunk")
    rank_file = read_ranks() if ranks is None else ranks
    kept = [c for c in (df.columns if keep is None else keep) if c in others(df, "ids")]
    size = F.length(text_of(text))
    cols = [F.col(quoted(c)) for c in kept]
    short = add_columns(df.filter(size <= chunk), text, "ids binary",
                        _encode_array(rank_file, pattern), kept)
    rows = df.filter(size > chunk).select(
        F.struct(*cols, F.lit(0).alias("__llm_pad")).alias("row"), text_of(text).alias("t"))
    rows = rows.withColumn("key", F.unhex(F.sha2("t", 256)))
    coded = _encode_long(rows.select("key", "t"), rank_file, pattern, chunk, overlap)
    long = rows.select("row", "key").join(coded, "key").select(
        *[F.col(f"row.{quoted(c)}").alias(c) for c in kept], "ids")
    return short.unionByName(long)


def decode(df: DataFrame, ids: str = "ids", *, ranks: bytes | None = None) -> DataFrame:
    """Append ``decoded``: the concatenated bytes of the ids (null ids: empty).

    An id outside the vocabulary raises ``KeyError``.
    """
    rank_file = read_ranks() if ranks is None else ranks
    kept = others(df, "decoded")
    rows = df.select(*[F.col(quoted(c)) for c in kept],
                     F.coalesce(F.col(quoted(ids)), F.lit(b"")).alias("__llm_ids"))

    def run(batches):
        pieces = token_bytes(rank_file)
        for batch in batches:
            out = [b"".join(map(pieces.__getitem__, np.frombuffer(v.as_py(), "<u4").tolist()))
                   for v in batch.column(len(kept))]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(kept))), pa.array(out, pa.binary())],
                names=[*kept, "decoded"])

    schema = rows.select(*[F.col(quoted(c)) for c in kept]).schema.add("decoded", "binary")
    return in_arrow(rows, run, schema)


CODED = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def _coded(rows: DataFrame, column: str, kept: Sequence[str], with_ids: bool,
           ids_of: Callable[[], Callable[[pa.Scalar], np.ndarray]],
           rank_file: bytes, pattern: str) -> DataFrame:
    """``kept`` and, from the values of ``column``, the ids (if asked), their count and digests.

    One pass and one Python worker a task: a row's ids are decoded and digested
    at once, and rows leave in slices of about SLICE bytes, so neither the ids nor
    the decoded bytes of a batch are held together.
    """
    names = ["ids"] * with_ids + ["n_tokens", "ids_sha256", "decoded_sha256"]
    kinds = [pa.binary()] * with_ids + [pa.int64(), pa.string(), pa.string()]
    schema = rows.select(*[F.col(quoted(c)) for c in kept]).schema
    if with_ids:
        schema = schema.add("ids", "binary")
    for field in T.StructType.fromDDL(CODED).fields:
        schema = schema.add(field)

    def run(batches):
        own, enc = ids_of(), encoding(rank_file, pattern)
        for batch in batches:
            values, out, held, lo = batch.column(len(kept)), [], 0, 0
            for i, value in enumerate(values):
                ids = own(value)
                raw = ids.astype("<u4").tobytes()
                row = (len(ids), hashlib.sha256(raw).hexdigest(),
                       hashlib.sha256(enc.decode_bytes(ids.tolist())).hexdigest())
                out.append((raw, *row) if with_ids else row)
                held += len(raw) if with_ids else 128
                if held >= SLICE or i + 1 == len(values):
                    part = batch.slice(lo, len(out))
                    yield pa.RecordBatch.from_arrays(
                        [*(part.column(k) for k in range(len(kept))),
                         *(pa.array([o[k] for o in out], kind) for k, kind in enumerate(kinds))],
                        names=[*kept, *names])
                    out, held, lo = [], 0, i + 1

    return in_arrow(rows.select(*[F.col(quoted(c)) for c in kept], column), run, schema)


def round_trip(df: DataFrame, text: str = "text", *, ranks: bytes | None = None,
               pattern: str = public_tokenizers.PATTERN, chunk: int = CHUNK,
               overlap: int = OVERLAP, keep: Sequence[str] | None = None,
               with_ids: bool = False) -> DataFrame:
    """Encode every whole text and decode its ids again.

    Appends ``n_tokens``, ``ids_sha256`` (digest of the ids as little-endian
    unsigned 32-bit integers) and ``decoded_sha256`` (of the bytes they give back),
    with ``with_ids`` the ``ids`` too. Texts are chunked and stitched as in
    ``encode``; null and empty texts have no ids.
    """
    if not 0 < overlap <= chunk:
        raise ValueError("need 0 < overlap <= chunk")
    rank_file = read_ranks() if ranks is None else ranks
    taken = (["ids"] if with_ids else []) + T.StructType.fromDDL(CODED).names
    kept = [c for c in (df.columns if keep is None else keep) if c in others(df, *taken)]
    size = F.length(text_of(text))
    cols = [F.col(quoted(c)) for c in kept]

    def whole():
        enc = encoding(rank_file, pattern)
        return lambda t: enc.encode_to_numpy(t.as_py())

    def stored():
        return lambda ids: np.frombuffer(ids.as_py(), "<u4")

    short = _coded(df.filter(size <= chunk).select(*cols, text_of(text).alias(TEXT)), TEXT, kept,
                   with_ids, whole, rank_file, pattern)
    rows = df.filter(size > chunk).select(
        F.struct(*cols, F.lit(0).alias("__llm_pad")).alias("row"), text_of(text).alias("t"))
    rows = rows.withColumn("key", F.unhex(F.sha2("t", 256)))
    coded = _encode_long(rows.select("key", "t"), rank_file, pattern, chunk, overlap)
    digests = _coded(coded, "ids", ["key"], with_ids, stored, rank_file, pattern)
    long = rows.select("row", "key").join(digests, "key").select(
        *[F.col(f"row.{quoted(c)}").alias(c) for c in kept], *taken)
    return short.unionByName(long)


def op1_byte_bpe(spark, sf_dir: str) -> DataFrame:
    """Every whole text encoded, then decoded from its ids; digests of both."""
    return round_trip(table(spark, sf_dir, "documents"), keep=["doc_id"])
