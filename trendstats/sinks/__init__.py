"""Sinks: partitioned CSV / text writers."""

from trendstats.sinks.layout import (
    bucket_count,
    read_ranks,
    read_routed,
    write_bucketed_table,
    write_dated_table,
    write_ranked_list,
    write_routed,
)
from trendstats.sinks.named import category_files, write_named
from trendstats.sinks.writers import (
    snapshot_csv_frame,
    tuple_lines,
    video_csv_frame,
    write_by_category,
    write_clean_table,
    write_ranked,
    write_snapshot_csv,
    write_table,
    write_text_by_category,
)

__all__ = [
    "bucket_count",
    "category_files",
    "read_ranks",
    "read_routed",
    "snapshot_csv_frame",
    "tuple_lines",
    "video_csv_frame",
    "write_bucketed_table",
    "write_by_category",
    "write_clean_table",
    "write_dated_table",
    "write_named",
    "write_ranked",
    "write_ranked_list",
    "write_routed",
    "write_snapshot_csv",
    "write_table",
    "write_text_by_category",
]
