"""Column expressions: parsing, display lines and date cut-offs."""

from trendstats.functions.columns import (
    category_id_of_label,
    category_label,
    dated_line,
    display_line,
    nonnegative_bigint,
    prefixed_line,
    publish_date_of,
    ranked_line,
    record_csv_line,
    single_line,
    us_date,
    watch_url,
)
from trendstats.functions.dates import range_cutoff

__all__ = [
    "category_id_of_label",
    "category_label",
    "dated_line",
    "display_line",
    "nonnegative_bigint",
    "prefixed_line",
    "publish_date_of",
    "range_cutoff",
    "ranked_line",
    "record_csv_line",
    "single_line",
    "us_date",
    "watch_url",
]
