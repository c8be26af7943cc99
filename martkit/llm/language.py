"""Language identification by compression.

Each language is a zstandard raw-content dictionary made of training text. A
text is cut into pieces, every piece is compressed once per dictionary, and
the language whose compressed sizes sum to the least wins. Case is folded on
both sides. The margin is the relative gap to the runner-up; narrow margins are rejected.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import add_columns, quoted, table, text_of

DICT_BYTES = 1 << 18      # bytes of a language's dictionary, in whole texts (the fitted sample's bound)
PIECE_BYTES = 4096        # texts are compressed in pieces, so the dictionary counts throughout
LEVEL = 5
MIN_MARGIN = 0.002        # narrower relative margins are rejected
UNKNOWN = "und"

_LETTER = regex.compile(r"\p{L}")


def learn(train: DataFrame, text: str = "text", lang: str = "lang", *,
          size: int = DICT_BYTES) -> dict[str, bytes]:
    """One dictionary per language from a bounded sample of ``train``.

    A dictionary holds whole texts, up to ``size`` bytes in all: those whose content
    hash comes first, so equal tables give equal dictionaries, and repeated texts
    count once. A text that is too long for what is left of it is passed over, one
    longer than a dictionary by every dictionary. Rows with a null language
    or without a letter are not used. About twice ``size`` bytes a language reach
    the driver.
    """
    rows = (train.select(F.col(quoted(lang)).cast("string").alias("lang"),
                         text_of(text).alias("t"))
            .filter(F.col("lang").isNotNull() & F.col("t").rlike(r"\p{L}"))
            .filter(F.octet_length("t") <= size))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(
        F.sum(F.octet_length("t") + 1).alias("n")).collect()}
    if not sizes:
        return {}
    share = F.create_map(*[F.lit(x) for k, n in sizes.items()
                           for x in (k, min(1.0, 2 * size / max(n, 1)))])
    rank = F.pmod(F.xxhash64("t"), F.lit(1 << 40)) / float(1 << 40)
    picked = (rows.filter(rank < share[F.col("lang")])
              .groupBy("lang", rank.alias("rank"), "t").count().collect())
    out: dict[str, list[str]] = {}
    left: dict[str, int] = {}
    for r in sorted(picked, key=lambda r: (r["lang"], r["rank"], r["t"])):
        need = len(r["t"].encode()) + 1
        if need <= left.get(r["lang"], size + 1):
            left[r["lang"]] = left.get(r["lang"], size + 1) - need
            out.setdefault(r["lang"], []).append(r["t"])
    return {k: "\n".join(v).lower().encode() for k, v in sorted(out.items())}


def identify(df: DataFrame, dictionaries: Mapping[str, bytes], text: str = "text", *,
             min_margin: float = MIN_MARGIN, piece: int = PIECE_BYTES,
             keep: Sequence[str] | None = None) -> DataFrame:
    """Append ``lang_pred``, ``margin`` and ``rejected``.

    Null, empty and letterless texts (and all texts, without a dictionary) are
    ``und`` with margin 0 and rejected. Ties go to the first language by name.
    Otherwise a text is rejected if its margin is below ``min_margin``; the
    smallest language stays in ``lang_pred``.
    """
    dictionaries = dict(sorted(dictionaries.items()))

    def make():
        compress = []
        for raw in dictionaries.values():
            d = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            compress.append(zstandard.ZstdCompressor(
                dict_data=d, level=LEVEL, write_content_size=False, write_dict_id=False).compress)
        names = list(dictionaries)

        def sizes(data: bytes) -> list[int]:
            parts = [data[i:i + piece] for i in range(0, len(data), piece)]
            return [sum(len(c(p)) for p in parts) for c in compress]

        def work(texts: pa.Array):
            pred, margin = [], []
            for t in texts:
                t = t.as_py()
                if not names or not _LETTER.search(t):
                    pred.append(UNKNOWN)
                    margin.append(0.0)
                    continue
                each = sizes(t.lower().encode())
                best = min(range(len(each)), key=each.__getitem__)
                rest = [s for i, s in enumerate(each) if i != best]
                pred.append(names[best])
                margin.append((min(rest) - each[best]) / min(rest) if rest else 1.0)
            gone = [p == UNKNOWN or m < min_margin for p, m in zip(pred, margin)]
            return [pa.array(pred, pa.string()), pa.array(margin, pa.float64()), pa.array(gone)]

        return work

    return add_columns(df, text, "lang_pred string, margin double, rejected boolean", make, keep)


def held_out(doc_id: str = "doc_id"):
    """The rows that nothing is learned from: crc32 of the id as text is 2 modulo 4."""
    return F.coalesce(F.crc32(F.col(quoted(doc_id)).cast("string").cast("binary")) % 4 == 2,
                      F.lit(False))


def op9_language_id(spark, sf_dir: str) -> DataFrame:
    """Languages of all documents, learned from the rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    known = learn(docs.filter(~held_out()))
    out = identify(docs.withColumn("held_out", held_out()), known, keep=["doc_id", "held_out"])
    return out.select("doc_id", "held_out", "lang_pred", F.col("margin").alias("score"), "rejected")
