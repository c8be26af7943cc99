"""Tokenising and counting words, entirely as JVM expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


_REGEX_META = ".$|()[{^?*+\\"


def _quote(sep: str) -> str:
    """Regex-quote a literal separator (Spark's ``split`` takes a Java regex).

    A single non-metacharacter is passed as is: Java's ``String.split`` then
    takes its fast path instead of running the regex engine.
    """
    if len(sep) == 1 and sep not in _REGEX_META:
        return sep
    return "\\Q" + sep.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def split_words(col: Column | str, sep: str = " ", drop_trailing_empty: bool = False) -> Column:
    """Split on a literal separator.

    Default: every token is kept, empty ones included (Python ``str.split(sep)``).
    ``drop_trailing_empty``: Java ``String.split`` — trailing empty tokens are
    removed, and a string without the separator is returned whole.
    """
    if not sep:
        raise ValueError("separator must be non-empty")
    c = F.col(col) if isinstance(col, str) else col
    if not drop_trailing_empty:
        return F.split(c, _quote(sep), -1)
    # Trailing empty tokens come exactly from trailing separators, so strip
    # those first and split once. One character: ``rtrim`` of that character.
    # Longer: a regex (``\z`` is the true end; ``$`` would also match before
    # a final newline).
    if len(sep) == 1:
        stripped = F.rtrim(c, F.lit(sep))
    else:
        stripped = F.regexp_replace(c, "(?:" + _quote(sep) + ")+\\z", "")
    return (
        F.when(F.instr(c, sep) == 0, F.array(c))
        .when(stripped == "", F.array().cast("array<string>"))
        .otherwise(F.split(stripped, _quote(sep), -1))
    )


def word_count(
    df: DataFrame,
    text_col: str = "text",
    sep: str = " ",
    drop_trailing_empty: bool = False,
    word_col: str = "word",
    count_col: str = "n",
) -> DataFrame:
    """Count tokens, case-sensitive, over every row of ``text_col``.

    ``explode`` streams each text's tokens inside its task; the count is a
    partial aggregate before the shuffle, so a very frequent word (or the empty
    token) is pre-summed per task rather than shipped row by row.
    """
    words = df.select(F.explode(split_words(text_col, sep, drop_trailing_empty)).alias(word_col))
    return words.groupBy(word_col).agg(F.count(F.lit(1)).alias(count_col))
