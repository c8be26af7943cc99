"""The registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .bpe import op1_byte_bpe
from .decontaminate import op7_decontaminate
from .fingerprints import op5_fingerprints
from .jaccard import op6_jaccard_join
from .language import op9_language_id
from .licences import op3_licence_scan
from .passages import op12_repeated_passages
from .pii import op2_pii
from .prefix_trie import op11_prefix_trie
from .quality import op4_quality
from .runs import op13_periodic_runs
from .substrings import op10_repeated_substrings
from .wordpiece import op8_token_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_pii": op2_pii,
    "op3_licence_scan": op3_licence_scan,
    "op4_quality": op4_quality,
    "op5_fingerprints": op5_fingerprints,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_decontaminate": op7_decontaminate,
    "op8_token_counts": op8_token_counts,
    "op9_language_id": op9_language_id,
    "op10_repeated_substrings": op10_repeated_substrings,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_repeated_passages": op12_repeated_passages,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLE_SQL: dict[str, str] = {}
