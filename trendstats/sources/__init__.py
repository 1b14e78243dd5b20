"""Sources: trending CSV, category JSON and the test-table adapter."""

from trendstats.sources.categories import categories_from_table, category_items, read_categories
from trendstats.sources.tables import categories_from_tables, trending_from_tables
from trendstats.sources.trending import (
    as_field_map,
    read_clean_table,
    read_trending,
    reject_reason,
    rejected_records,
    valid_records,
    validity,
)

__all__ = [
    "as_field_map",
    "categories_from_table",
    "categories_from_tables",
    "category_items",
    "read_categories",
    "read_clean_table",
    "read_trending",
    "reject_reason",
    "rejected_records",
    "trending_from_tables",
    "valid_records",
    "validity",
]
