"""trendstats — trending-video analytics as Spark DataFrame plans.

The main entry points, re-exported here:

    from trendstats import get_session, read_trending, read_categories, rollup_videos, topk_videos
"""

from trendstats.operators import (
    count_records_by_category,
    count_videos_by_category,
    filter_videos_by_category,
    in_categories,
    records_in_range,
    rollup_videos,
    run_summary,
    topk_records_by_category,
    topk_videos,
    topk_videos_by_category,
    with_category,
)
from trendstats.session import ensure_checkpoint_dir, get_session
from trendstats.sources import read_categories, read_clean_table, read_trending, rejected_records, valid_records

__version__ = "0.1.0"

__all__ = [
    "count_records_by_category",
    "count_videos_by_category",
    "ensure_checkpoint_dir",
    "filter_videos_by_category",
    "get_session",
    "in_categories",
    "read_categories",
    "read_clean_table",
    "read_trending",
    "records_in_range",
    "rejected_records",
    "rollup_videos",
    "run_summary",
    "topk_records_by_category",
    "topk_videos",
    "topk_videos_by_category",
    "valid_records",
    "with_category",
]
