"""Sources: Parquet/CSV files, relational databases, raw JSON responses."""

from .documents import Flattened, flatten_documents, flatten_products, listing_ids
from .files import deal_out, read_ids, read_landing, read_parquet, read_responses, text_frame
from .jdbc import (Partitioning, bounds_from, driver_class, jdbc_options, jdbc_url, quantile_query,
                   range_predicates, read_jdbc)

__all__ = ["deal_out", "Flattened", "flatten_documents", "flatten_products", "listing_ids", "read_ids",
           "read_landing", "read_parquet", "read_responses", "text_frame", "bounds_from", "driver_class",
           "jdbc_options", "jdbc_url", "read_jdbc", "Partitioning", "quantile_query", "range_predicates"]
