"""Landing raw JSON responses as typed tables, distributed.

Inputs are tables of ``(status, body)``: one HTTP response per row, stored
wherever the fetcher put them. Parsing is VARIANT-based, so "key missing" and
"key present with JSON null" are told apart, which ``from_json`` cannot do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.json import parse
from ..operators.shared import Outputs

# The product document contract of the original crawler.
# (output column, JSON path, Spark type) — required keys, in output order.
PRODUCT_FIELDS = [
    ("id", "$.id", "bigint"),
    ("sku", "$.sku", "string"),
    ("name", "$.name", "string"),
    ("short_description", "$.short_description", "string"),
    ("price", "$.price", "bigint"),
    ("original_price", "$.original_price", "bigint"),
    ("discount", "$.discount", "bigint"),
    ("discount_rate", "$.discount_rate", "bigint"),
    ("rating_average", "$.rating_average", "double"),
    ("reviews_count", "$.review_count", "bigint"),
    ("inventory_status", "$.inventory_status", "string"),
    ("brand_id", "$.brand.id", "bigint"),
    ("brand_name", "$.brand.name", "string"),
    ("category_id", "$.categories.id", "bigint"),
    ("category_name", "$.categories.name", "string"),
]
# Nested members that must be JSON objects.
PRODUCT_OBJECTS = ["$.brand", "$.categories"]
OK_STATUS = 200


class Flattened(Outputs):
    """Accepted rows (typed, flat) and rejected rows (original body + reason).

    Each is a plan that parses the documents; inside ``with`` they are parsed once
    for both, and the judged documents persisted (or checkpointed).
    """

    def __init__(self, judged: DataFrame, columns: list[str], body: str):
        super().__init__({"judged": lambda _: judged}, lambda held: {
            "rows": lambda: held["judged"].filter(F.col("reason").isNull()).select(*columns),
            "rejected": lambda: held["judged"].filter(F.col("reason").isNotNull()).select(
                body, "reason")})

    @property
    def rows(self) -> DataFrame:
        return self["rows"]

    @property
    def rejected(self) -> DataFrame:
        return self["rejected"]


def _split_path(path: str) -> tuple[str, ...]:
    if not path.startswith("$."):
        raise ValueError(f"paths must look like $.a or $.a.b, got {path!r}")
    parts = tuple(path[2:].split("."))
    if len(parts) > 2:
        raise ValueError(f"at most one level of nesting is supported, got {path!r}")
    return parts


def _variant_struct(names) -> str:
    return "struct<" + ",".join(f"`{n}`: variant" for n in names) + ">"


# Column expressions are unresolved trees, reusable across DataFrames; they are
# built once per (application, contract) to save thousands of JVM round trips.
_PLANS: dict[tuple, tuple] = {}


def _contract_columns(fields, objects, body_col: str) -> tuple:
    paths = {name: _split_path(path) for name, path, _ in fields}
    nested = sorted({p[0] for p in paths.values() if len(p) == 2} | {_split_path(o)[0] for o in objects})
    tops = list(dict.fromkeys(p[0] for p in paths.values()))
    tops += [n for n in nested if n not in tops]
    members = {n: list(dict.fromkeys(p[1] for p in paths.values() if len(p) == 2 and p[0] == n))
               for n in nested}

    # Casting to a struct is NULL for anything but a JSON object, so no schema
    # walk of the whole document is needed to tell objects from the rest.
    v = parse(body_col)
    stage1 = [
        F.col(body_col),
        v.isNotNull().alias("__parsed"),
        F.try_variant_get(v, "$", _variant_struct(tops)).alias("__top"),
    ]
    stage2 = [
        F.try_variant_get(F.col("__top")[n], "$", _variant_struct(members[n])).alias(f"__obj_{n}")
        for n in nested if members[n]
    ]

    def raw(parts: tuple[str, ...]) -> Column:
        if len(parts) == 1:
            return F.col("__top")[parts[0]]
        return F.col(f"__obj_{parts[0]}")[parts[1]]

    checks = [
        F.when(~F.col("__parsed"), F.lit("unparseable or duplicate keys")),
        F.when(F.col("__top").isNull(), F.lit("not an object")),
    ]
    for o in objects:
        n = _split_path(o)[0]
        member = F.col("__top")[n]
        not_object = (F.col(f"__obj_{n}").isNull() if members[n]
                      else ~F.schema_of_variant(member).startswith("OBJECT"))
        checks.append(F.when(member.isNotNull() & not_object, F.lit(f"not an object {o[2:]}")))
    typed = []
    for name, _, type_ in fields:
        r = raw(paths[name])
        value = F.try_variant_get(r, "$", type_)
        usable = r.isNotNull() & ~F.is_variant_null(r)
        bad = usable & value.isNull()
        if type_ in ("bigint", "int", "smallint", "tinyint"):
            # A fractional number would be truncated by the integral cast.
            as_double = F.try_variant_get(r, "$", "double")
            bad = bad | (usable & as_double.isNotNull() & (as_double != value.cast("double")))
        checks.append(F.when(r.isNull(), F.lit(f"missing key {name}")))
        checks.append(F.when(bad, F.lit(f"bad type {name}")))
        typed.append(value.alias(name))
    # One-element ``inline`` is a barrier for filter pushdown: without it the
    # ``reason`` filter is pushed under this projection and the whole parse is
    # inlined into it, evaluated twice per document.
    verdict = F.inline(F.array(F.struct(F.col(body_col).alias(body_col),
                                        F.coalesce(*checks).alias("reason"), *typed)))
    return stage1, stage2, verdict


def flatten_documents(
    responses: DataFrame,
    fields=PRODUCT_FIELDS,
    objects=PRODUCT_OBJECTS,
    body_col: str = "body",
    status_col: str | None = "status",
) -> Flattened:
    """Parse each body and keep it only if every field is usable.

    Rules: a response whose status is not 200 is skipped. An unparseable body,
    a missing key, a nested member that is not an object, or a value that
    cannot be cast losslessly rejects the whole document (with a reason). A key
    present with JSON null is kept as null; extra keys are ignored. Duplicate
    keys make the body unparseable.

    Each document is parsed once and cast once into a struct of VARIANT
    members (one more cast per nested object); the typed columns are cast
    from those members, which keeps the generated code small.
    """
    key = (responses.sparkSession.sparkContext.applicationId, tuple(fields), tuple(objects), body_col)
    if key not in _PLANS:
        _PLANS[key] = _contract_columns(fields, objects, body_col)
    stage1, stage2, verdict = _PLANS[key]

    src = responses
    if status_col is not None:
        src = src.filter(F.col(status_col) == OK_STATUS)
    stage = src.select(*stage1)
    if stage2:
        stage = stage.select("*", *stage2)
    judged = stage.select(verdict)
    return Flattened(judged, [name for name, _, _ in fields], body_col)


def flatten_products(responses: DataFrame, body_col: str = "body",
                     status_col: str | None = "status") -> Flattened:
    """Product documents → the 15-column flat product table."""
    return flatten_documents(responses, PRODUCT_FIELDS, PRODUCT_OBJECTS, body_col, status_col)


def listing_ids(
    responses: DataFrame,
    body_col: str = "body",
    status_col: str | None = "status",
    list_path: str = "$.data",
    id_path: str = "$.id",
    on_missing: str = "fail",
) -> DataFrame:
    """Listing responses → one row per listed item id (``id`` BIGINT).

    A status other than 200 is skipped. An item without an id gives a null id.
    A body without the list fails the job (``on_missing="fail"``, as the
    original does) or is skipped (``"skip"``). Ids are not de-duplicated.
    """
    src = responses
    if status_col is not None:
        src = src.filter(F.col(status_col) == OK_STATUS)
    items = F.try_variant_get(parse(body_col), list_path, "array<variant>")
    # One-element ``inline`` is a barrier: the body is parsed once, below it.
    listed = src.select(F.inline(F.array(F.struct(items.alias("__items")))))
    if on_missing == "fail":
        listed = listed.select(F.when(
            F.col("__items").isNull(),
            F.raise_error(F.lit(f"listing body without an array at {list_path}")))
            .otherwise(F.col("__items")).alias("__items"))
    elif on_missing != "skip":
        raise ValueError("on_missing must be 'fail' or 'skip'")
    return listed.select(F.explode("__items").alias("__item")).select(
        F.try_variant_get(F.col("__item"), id_path, "bigint").alias("id")
    )
