"""Relational operators: every function maps DataFrames to DataFrames."""

from .aggregate import SharedAggregates, aggregate, aggregate_many
from .cache import cached, reliable_checkpoint, set_shuffle_partitions
from .filter import filter_optional, not_in, project, rename, to_column
from .joins import Table, broadcast_if_bounded, check_join_columns, join_program, join_using
from .shape import (dim_distinct, drop_duplicate_facts, require_unique_key, star_split,
                    unique_key_violations)

__all__ = [
    "SharedAggregates", "aggregate", "aggregate_many", "cached", "reliable_checkpoint",
    "set_shuffle_partitions", "filter_optional", "not_in", "project", "rename", "to_column",
    "Table", "broadcast_if_bounded", "check_join_columns", "join_program", "join_using",
    "dim_distinct", "star_split", "unique_key_violations", "require_unique_key",
    "drop_duplicate_facts",
]
