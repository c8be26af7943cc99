"""Column-level functions (all built-in Spark expressions, no Python UDFs)."""

from pyspark.sql import functions as _F

from .json import is_object, is_present, json_path, parse, variant_path
from .text import split_words, word_count


def round_half_up(col, scale: int = 2):
    """``round(x, scale)`` with Spark's HALF_UP rounding (the jobs' ``round``)."""
    return _F.round(col, scale)


__all__ = ["is_object", "is_present", "json_path", "parse", "variant_path",
           "split_words", "word_count", "round_half_up"]
