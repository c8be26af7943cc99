"""The three warehouse pipelines as pure functions: star tables in, named outputs out.

Each pipeline is one lazy lineage; nothing is staged in a database between
steps, so Catalyst optimises across what used to be separate jobs. Dimension
joins name the dimension as the broadcast side; it is broadcast only if the
size probe proves it small, otherwise the join is a shuffle join under AQE.

Eager aggregation (``Roles.eager``, on by default): the pipelines' aggregates
are decomposable (count, sum, avg), so the fact is first aggregated by the
join keys, the much smaller partial result is joined to the dimensions, and
the partials are merged per output group (sum of counts, sum of sums, sum /
count). Results are identical to join-then-aggregate, fan-out from duplicate
dimension keys included, because the merge runs over the joined rows. At
scale this replaces a shuffle of every fact row per non-broadcast join with a
shuffle of one row per (key, key) pair.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.aggregate import aggregate, aggregate_many, computes_on, resolves_on
from ..operators.filter import filter_optional, to_column
from ..operators.joins import Table, join_program, join_using, reduce_by_keys
from ..operators.shape import drop_duplicate_facts, require_unique_key, star_split
from ..operators.shared import Frames, Outputs
from ..spec import AggSpec, JoinStep


@dataclass(frozen=True)
class Roles:
    """Column names and arguments of the pipelines.

    The defaults are the original pipeline arguments (fixed values); other
    data sets map their own columns onto the same roles.
    """

    id: str = "id"
    brand_key: str = "brand_id"
    brand_name: str = "brand_name"
    category_key: str = "category_id"
    category_name: str = "category_name"
    rating: str = "rating_average"
    reviews: str = "reviews_count"
    product_filter: str = "discount_rate > 10"
    category_filter: str = "category_id NOT IN (2, 28856)"
    rating_filter: str = "rating_average > 0"
    # HAVING over the output columns; same meaning as count(id) > 5 and
    # sum(reviews_count) <> 0 (aggregate-expression forms are accepted too).
    count_having: str = "number_of_products > 5"
    sum_having: str = "number_of_reviews <> 0"
    average_filter: str = "average_rating > 4.5"
    count_alias: str = "number_of_products"
    sum_alias: str = "number_of_reviews"
    average_alias: str = "average_rating"
    broadcast_dims: bool = True
    eager: bool = True
    # Joins of the fact with a dimension that is not broadcast (see ``join_using``):
    # hot fact keys, the columns that tell fact rows apart, and whether fact rows
    # without a partner in a filtered dimension go before the shuffle.
    salt_buckets: int = 0
    hot: Sequence | str | None = None
    row_id: tuple[str, ...] | None = None
    key_filter: bool = False

    def with_(self, **changes) -> "Roles":
        return replace(self, **changes)


REFERENCE = Roles()


def _numeric(df: DataFrame, column: str) -> bool:
    """Eager merging reproduces avg/sum exactly for integral and floating types."""
    dtype = df.schema[column].dataType
    return isinstance(dtype, (T.IntegralType, T.FloatType, T.DoubleType))


def _eager_average(product: DataFrame, roles: Roles) -> bool:
    """The average can be pre-aggregated: on a filter over dimension columns it cannot."""
    return (roles.eager and _numeric(product, roles.rating)
            and (not roles.rating_filter or computes_on(product, roles.rating_filter)))


def _average_parts(roles: Roles) -> list:
    """Partials of ``avg(rating)`` over rows passing ``rating_filter``."""
    passed = to_column(roles.rating_filter) if roles.rating_filter else F.lit(True)
    # As a double, as ``avg`` sums integral columns: large integers do not overflow.
    rating = F.when(passed, F.col(roles.rating).cast("double"))
    return [
        F.sum(rating).alias("__sum_rating"),
        F.count(rating).alias("__cnt_rating"),
        F.max(F.when(passed, F.lit(1))).alias("__any_rated"),  # group has a passing row
    ]


def _merged_average(roles: Roles):
    return F.round(F.try_divide(F.sum("__sum_rating"), F.sum("__cnt_rating")), 2).alias(
        roles.average_alias)


def warehouse(flat: DataFrame, roles: Roles = REFERENCE,
              dedupe: bool = False, unique_dims: bool = False) -> Outputs:
    """Flat product table → ``product`` (fact), ``brand``, ``category``.

    Inside ``with`` the flat table is computed once for all three (``star_split``).
    ``dedupe`` keeps one fact row per id; ``unique_dims`` fails if a dimension
    key maps to more than one name. Both are off by default, as in the original.
    """
    if dedupe:
        flat = drop_duplicate_facts(flat, roles.id)
    fact_cols = [c for c in flat.columns if c not in (roles.brand_name, roles.category_name)]
    star = star_split(
        flat,
        fact_cols,
        {"brand": [roles.brand_key, roles.brand_name],
         "category": [roles.category_key, roles.category_name]},
        fact_name="product",
    )
    if unique_dims:
        require_unique_key(star["brand"], roles.brand_key)
        require_unique_key(star["category"], roles.category_key)
    return star


def _dim(roles: Roles, side: str) -> str | None:
    return side if roles.broadcast_dims else None


def _average_spec(roles: Roles) -> AggSpec:
    return AggSpec.of(
        keys=[roles.brand_key, roles.category_key, roles.brand_name],
        aggs=[f"round(avg({roles.rating}), 2) AS {roles.average_alias}"],
        where=roles.rating_filter,
        name="agg_brand_average_rate",
    )


def _category_count_spec(roles: Roles) -> AggSpec:
    return AggSpec.of(
        keys=[roles.category_key, roles.category_name],
        aggs=[f"count({roles.id}) AS {roles.count_alias}"],
        name="agg_products_each_category",
    )


def _fact_join(fact: DataFrame, dim: DataFrame, on: str, roles: Roles) -> DataFrame:
    """The fact joined to a dimension, broadcast if it is small, else as ``roles`` say."""
    return join_using(fact, dim, on, "inner", broadcast=_dim(roles, "right"),
                      salt_buckets=roles.salt_buckets, hot=roles.hot, row_id=roles.row_id,
                      key_filter=roles.key_filter)


def pipeline_v1(product: DataFrame, brand: DataFrame, roles: Roles = REFERENCE) -> Mapping:
    """brand ⨝ filtered product → count per brand and review sum per brand.

    Both outputs group by the same keys, so they come from one aggregate over
    one join (the original cached the join and aggregated it twice).
    Outputs: ``product_count_brand``, ``product_sum_brand``.
    """
    keys = [roles.brand_key, roles.brand_name]
    fact = filter_optional(product, roles.product_filter)
    if roles.eager and _numeric(product, roles.reviews):
        partial = fact.groupBy(roles.brand_key).agg(
            F.count(F.col(roles.id)).alias("__cnt_id"), F.sum(roles.reviews).alias("__sum_reviews"))
        joined = join_using(brand, partial, roles.brand_key, "inner", broadcast=_dim(roles, "left"))
        merged = joined.groupBy(*keys).agg(F.sum("__cnt_id").alias(roles.count_alias),
                                           F.sum("__sum_reviews").alias(roles.sum_alias))
        counts = merged.select(*keys, roles.count_alias)
        sums = merged.select(*keys, roles.sum_alias)
        if resolves_on(counts, roles.count_having) and resolves_on(sums, roles.sum_having):
            return Outputs({"merged": lambda _: merged}, lambda held: {
                "product_count_brand": lambda: filter_optional(
                    held["merged"].select(*keys, roles.count_alias), roles.count_having),
                "product_sum_brand": lambda: filter_optional(
                    held["merged"].select(*keys, roles.sum_alias), roles.sum_having),
            })
    # the fact is the left side, so that its hot brands can be split off or salted
    joined = _fact_join(fact, brand, roles.brand_key, roles)
    return aggregate_many(joined, [
        AggSpec.of(keys, [f"count({roles.id}) AS {roles.count_alias}"],
                   having=roles.count_having, name="product_count_brand"),
        AggSpec.of(keys, [f"sum({roles.reviews}) AS {roles.sum_alias}"],
                   having=roles.sum_having, name="product_sum_brand"),
    ])


def pipeline_v2(product: DataFrame, brand: DataFrame, category: DataFrame,
                roles: Roles = REFERENCE) -> Outputs:
    """Two 2-way joins, an average per brand/category, a count per category,
    and the high averages joined back to the category dimension.

    The average is one shared intermediate of the two outputs that read it. Eager
    (default), one partial aggregate of the filtered fact per (brand, category)
    feeds the average and the count, and is an intermediate, too.
    Outputs: ``product_brand_tmp``, ``product_category_tmp``,
    ``agg_brand_average_rate``, ``agg_products_each_category``,
    ``category_brand_average``.
    """
    fact = filter_optional(product, roles.product_filter)
    spec, count_spec = _average_spec(roles), _category_count_spec(roles)

    @cache
    def product_brand() -> DataFrame:
        return _fact_join(fact, brand, roles.brand_key, roles)

    @cache
    def product_category() -> DataFrame:
        return _fact_join(fact, category, roles.category_key, roles)

    def partial(_: Frames) -> DataFrame:
        return fact.groupBy(roles.brand_key, roles.category_key).agg(
            *_average_parts(roles), F.count(F.col(roles.id)).alias("__cnt_id"))

    def merged_average(held: Frames) -> DataFrame:
        rated = join_using(held["partial"].drop("__cnt_id"), brand, roles.brand_key, "inner",
                           broadcast=_dim(roles, "right"))
        return (rated.filter(F.col("__any_rated").isNotNull())
                .groupBy(roles.brand_key, roles.category_key, roles.brand_name)
                .agg(_merged_average(roles)))

    def merged_count(held: Frames) -> DataFrame:
        if held.held:
            by_category = held["partial"].groupBy(roles.category_key).agg(
                F.sum("__cnt_id").alias("__cnt_id"))
        else:  # for this output alone the brand is no group key
            by_category = fact.groupBy(roles.category_key).agg(
                F.count(F.col(roles.id)).alias("__cnt_id"))
        counted = join_using(by_category, category, roles.category_key, "inner",
                             broadcast=_dim(roles, "right"))
        return counted.groupBy(roles.category_key, roles.category_name).agg(
            F.sum("__cnt_id").alias(roles.count_alias))

    eager = _eager_average(product, roles)
    stages: dict[str, Callable] = {"partial": partial, "average": merged_average} if eager else {
        "average": lambda _: aggregate(product_brand(), spec.keys, spec.aggs, where=spec.where)}

    def derive(held: Frames) -> dict[str, Callable[[], DataFrame]]:
        return {
            "product_brand_tmp": product_brand,
            "product_category_tmp": product_category,
            "agg_brand_average_rate": lambda: held["average"],
            "agg_products_each_category": lambda: (
                merged_count(held) if eager
                else aggregate(product_category(), count_spec.keys, count_spec.aggs)),
            "category_brand_average": lambda: join_using(
                held["average"], category, roles.category_key, "inner",
                left_filter=roles.average_filter, broadcast=_dim(roles, "right")),
        }

    return Outputs(stages, derive)


def v3_join(product: DataFrame, brand: DataFrame, category: DataFrame,
            roles: Roles = REFERENCE) -> DataFrame:
    """``product_brand_category``: the 3-table join program of the V3 pipeline.

    With ``roles.key_filter``, fact rows of categories that the filtered category
    dimension lacks go before the first join, unless that dimension is broadcast.
    """
    hint = _dim(roles, "right")
    fact = filter_optional(product, roles.product_filter)
    if roles.key_filter and not roles.broadcast_dims:
        fact = reduce_by_keys(fact, filter_optional(category, roles.category_filter),
                              roles.category_key)
    return join_program(
        [Table(fact), Table(brand), Table(category, roles.category_filter)],
        [JoinStep(0, 1, roles.brand_key, "inner"), JoinStep(3, 2, roles.category_key, "inner")],
        broadcast=[hint, hint], salt_buckets=roles.salt_buckets,
        hot=roles.hot, row_id=roles.row_id,
    )


def pipeline_v3(product: DataFrame, brand: DataFrame, category: DataFrame,
                roles: Roles = REFERENCE) -> Mapping:
    """3-way join, then an average per brand/category and a count per category.

    Eager (default): one partial aggregate of the filtered fact per
    (brand, category) carries both outputs' partials through the same two
    joins; each output merges them. Otherwise both outputs come from one
    tagged pass over the full join (``operators.aggregate.SharedAggregates``),
    of which group rows only are held.
    Outputs: ``agg_brand_average_rate``, ``agg_products_each_category``.
    """
    if _eager_average(product, roles):
        fact = filter_optional(product, roles.product_filter)
        partial = fact.groupBy(roles.brand_key, roles.category_key).agg(
            *_average_parts(roles), F.count(F.col(roles.id)).alias("__cnt_id"))
        hint = _dim(roles, "right")
        joined = join_program(
            [Table(partial), Table(brand), Table(category, roles.category_filter)],
            [JoinStep(0, 1, roles.brand_key, "inner"), JoinStep(3, 2, roles.category_key, "inner")],
            broadcast=[hint, hint],
        )
        return Outputs({"joined": lambda _: joined}, lambda held: {
            "agg_brand_average_rate": lambda: (
                held["joined"].filter(F.col("__any_rated").isNotNull())
                .groupBy(roles.brand_key, roles.category_key, roles.brand_name)
                .agg(_merged_average(roles))),
            "agg_products_each_category": lambda: held["joined"].groupBy(
                roles.category_key, roles.category_name).agg(
                F.sum("__cnt_id").alias(roles.count_alias)),
        })
    joined = v3_join(product, brand, category, roles)
    return aggregate_many(joined, [_average_spec(roles), _category_count_spec(roles)])
