"""DataFrame → DataFrame operators."""

from trendstats.operators.aggregate import (
    count_in_range,
    count_records_by_category,
    count_videos_by_category,
    counts_with_total,
    exact_sum,
    rollup_videos,
    run_summary,
    sum_likes_dislikes_by_category,
    sum_views_by_category,
    summary_columns,
    video_parts,
    videos_of_parts,
)
from trendstats.operators.joins import (
    in_categories,
    list_categories,
    selected_categories,
    selection,
    titled,
    unknown_categories,
    with_category,
)
from trendstats.operators.rank import (
    RECORD_OUT,
    filter_records_by_category,
    filter_videos_by_category,
    number_within,
    reaching_top,
    records_in_range,
    sort_records_by_views,
    topk,
    topk_records_by_category,
    topk_videos,
    topk_videos_by_category,
    topk_within,
)
from trendstats.operators.select import display_ready, published_in, published_since, valid_publish_date

__all__ = [
    "RECORD_OUT",
    "count_in_range",
    "count_records_by_category",
    "count_videos_by_category",
    "counts_with_total",
    "display_ready",
    "exact_sum",
    "filter_records_by_category",
    "filter_videos_by_category",
    "in_categories",
    "list_categories",
    "number_within",
    "published_in",
    "published_since",
    "reaching_top",
    "records_in_range",
    "rollup_videos",
    "run_summary",
    "selected_categories",
    "selection",
    "sort_records_by_views",
    "sum_likes_dislikes_by_category",
    "sum_views_by_category",
    "summary_columns",
    "topk",
    "topk_records_by_category",
    "topk_videos",
    "topk_videos_by_category",
    "titled",
    "topk_within",
    "unknown_categories",
    "valid_publish_date",
    "video_parts",
    "videos_of_parts",
    "with_category",
]
