"""Column names, types and fixed values shared by every module.

The clean *record* schema sits between the sources and the operators:
one row per video per trending day,

    video_id string, trending_date date, title string, channel_title string,
    category_id int, publish_date date, views bigint, likes bigint, dislikes bigint

Both the CSV source (``sources.trending``) and the test-table adapter
(``sources.tables``) produce it, so every operator runs unchanged on either.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values (must equal the original application's) -------------------
# Column order of the trending CSV, and its header line.
RAW_COLUMNS = (
    "video_id",
    "trending_date",
    "title",
    "channel_title",
    "category_id",
    "publish_time",
    "tags",
    "views",
    "likes",
    "dislikes",
    "comment_count",
    "thumbnail_link",
    "comments_disabled",
    "ratings_disabled",
    "video_error_or_removed",
    "description",
)
HEADER_LINE = ",".join(RAW_COLUMNS)
# Header of the per-video CSV output.
VIDEO_CSV_HEADER = (
    "title",
    "category_id:category",
    "publish_date",
    "trending_date",
    "channel_title",
    "views",
    "likes",
    "dislikes",
    "URL",
)
# Prefix of the watch URL built from a video id.
WATCH_URL_PREFIX = "https://www.youtube.com/watch?v="
# The five categories of the record-grain jobs: Music, Entertainment,
# News & Politics, Education, Science & Technology.
FOCUS_IDS = (10, 24, 25, 27, 28)
# Date-range names accepted by the range jobs.
RANGES = ("last-week", "last-month", "last-6-Months", "last-year", "no-date-filter")
# Format of trending_date in the public data set (two-digit year, day, month).
TRENDING_DATE_FORMAT = "yy.dd.MM"
# Comma that is followed by an even number of quotes up to the end of line:
# the line-exact field separator.
QUOTE_AWARE_COMMA = ',(?=([^"]*"[^"]*")*[^"]*$)'
# --- end of fixed values ----------------------------------------------------

METRICS = ("views", "likes", "dislikes")

RECORD_COLUMNS = (
    "video_id",
    "trending_date",
    "title",
    "channel_title",
    "category_id",
    "publish_date",
    "views",
    "likes",
    "dislikes",
)

# One row per video after the rollup (the CSV sink joins category_id and
# category into one ``id:title`` field).
VIDEO_COLUMNS = (
    "video_id",
    "title",
    "category_id",
    "category",
    "publish_date",
    "trending_date",
    "channel_title",
    "views",
    "likes",
    "dislikes",
    "url",
)


def raw_schema(corrupt_column: str | None = "_corrupt") -> T.StructType:
    """All 16 CSV fields as strings (numbers are cast later, so that a bad
    number and a bad row width stay separate reject reasons)."""
    fields = [T.StructField(c, T.StringType()) for c in RAW_COLUMNS]
    if corrupt_column:
        fields.append(T.StructField(corrupt_column, T.StringType()))
    return T.StructType(fields)


def check_metric(metric: str) -> str:
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}, got {metric!r}")
    return metric
