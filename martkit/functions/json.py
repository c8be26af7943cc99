"""Reading fields out of JSON text without leaving the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse(col: Column | str) -> Column:
    """JSON text → VARIANT; null when the text does not parse."""
    c = F.col(col) if isinstance(col, str) else col
    return F.try_parse_json(c)


def json_path(col: Column | str, path: str, type_: str = "string") -> Column:
    """Typed value at ``path`` (``$.a.b``); null when missing or not castable."""
    return F.try_variant_get(parse(col), path, type_)


def variant_path(v: Column, path: str, type_: str = "string") -> Column:
    """Typed value at ``path`` of an already parsed VARIANT column."""
    return F.try_variant_get(v, path, type_)


def is_present(v: Column, path: str) -> Column:
    """True when ``path`` exists, even if its value is JSON null."""
    return F.try_variant_get(v, path, "variant").isNotNull()


def is_object(v: Column, path: str) -> Column:
    """True when the value at ``path`` is a JSON object."""
    inner = F.try_variant_get(v, path, "variant")
    return inner.isNotNull() & F.schema_of_variant(inner).startswith("OBJECT")
