"""Registered queries over the driver's tables.

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame built from
the adapter view (``sources.tables``) and the library operators, with the
fixed test parameters below. ``plans.oracle`` holds the equivalent SQL.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendstats import operators as op
from trendstats.functions.columns import single_line
from trendstats.plans.menu import menu_query
from trendstats.schema import HEADER_LINE, METRICS, RECORD_COLUMNS, VIDEO_COLUMNS
from trendstats.session import remove, scratch
from trendstats.sinks import write_snapshot_csv
from trendstats.sources.tables import categories_from_tables, trending_from_tables
from trendstats.sources.trending import as_field_map, read_trending, rejected_records, valid_records

# Test parameters (the adapter's categories are brand numbers 1-25 and the
# dimension is the nation table, ids 0-24).
FOCUS = (3, 7, 10, 15, 24)  # record-grain focus ids and menu selection
CHOSEN_WITH_UNKNOWN = (3, 7, 25, 99)  # a selection with ids missing from the dimension
YEAR = 1998
K_PER_CATEGORY = 5
K_OVERALL = 10
K_MANY = 1500  # beyond one window a group
DIRT = 13  # order keys modulo this: 0-8 are bad in a way each
AS_OF = dt.date(1998, 8, 31)
SINGLE_CATEGORY = 10
SUMMARY_RANGE = "last-year"
RANGE_QUERIES = {
    "records_last_week": "last-week",
    "records_last_month": "last-month",
    "records_last_6_months": "last-6-Months",
    "records_last_year": "last-year",
    "records_all_time": "no-date-filter",
}

Query = Callable[[SparkSession, str], DataFrame]


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trending_from_tables(spark, sf_dir)


def _cats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return categories_from_tables(spark, sf_dir)


def _videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.rollup_videos(_records(spark, sf_dir), _cats(spark, sf_dir))


def _untitled_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rollup without the category title; queries that keep few videos
    add the title after filtering / top-k (``op.titled``)."""
    return op.rollup_videos(_records(spark, sf_dir))


def rollup_videos(spark, sf_dir):
    return _videos(spark, sf_dir)


def list_categories(spark, sf_dir):
    return op.list_categories(_cats(spark, sf_dir))


def selected_categories(spark, sf_dir):
    return op.selected_categories(spark, CHOSEN_WITH_UNKNOWN, _cats(spark, sf_dir))


def unknown_categories(spark, sf_dir):
    return op.unknown_categories(spark, CHOSEN_WITH_UNKNOWN, _cats(spark, sf_dir))


def with_category(spark, sf_dir):
    recs = valid_records(_records(spark, sf_dir))
    return op.with_category(recs, _cats(spark, sf_dir)).select(*RECORD_COLUMNS, "category")


def count_videos_by_category(spark, sf_dir):
    videos = op.rollup_videos(_records(spark, sf_dir))  # counting needs no titles
    return op.count_videos_by_category(spark, videos, _cats(spark, sf_dir), None)


def filter_videos_by_category(spark, sf_dir):
    chosen = op.in_categories(_untitled_videos(spark, sf_dir), FOCUS)
    return op.filter_videos_by_category(op.titled(chosen, _cats(spark, sf_dir), VIDEO_COLUMNS), None)


def _topk_by_category(metric):
    def q(spark, sf_dir):
        top = op.topk_videos_by_category(_untitled_videos(spark, sf_dir), metric, K_PER_CATEGORY, FOCUS)
        return op.titled(top, _cats(spark, sf_dir), [*VIDEO_COLUMNS, "rank"])

    return q


def _topk(metric, year=None):
    def q(spark, sf_dir):
        top = op.topk_videos(_untitled_videos(spark, sf_dir), metric, K_OVERALL, FOCUS, year)
        return op.titled(top, _cats(spark, sf_dir), [*VIDEO_COLUMNS, "rank"])

    return q


def count_records_by_category(spark, sf_dir):
    return op.count_records_by_category(spark, _records(spark, sf_dir), _cats(spark, sf_dir), FOCUS)


def sum_views_by_category(spark, sf_dir):
    return op.sum_views_by_category(_records(spark, sf_dir), _cats(spark, sf_dir), FOCUS)


def sum_likes_dislikes_by_category(spark, sf_dir):
    return op.sum_likes_dislikes_by_category(_records(spark, sf_dir), _cats(spark, sf_dir), FOCUS)


def sort_records_by_views(spark, sf_dir):
    return op.sort_records_by_views(_records(spark, sf_dir), _cats(spark, sf_dir), FOCUS)


def filter_records_by_category(spark, sf_dir):
    return op.filter_records_by_category(_records(spark, sf_dir), SINGLE_CATEGORY)


def _topk_records(metric):
    def q(spark, sf_dir):
        return op.topk_records_by_category(_records(spark, sf_dir), metric, K_PER_CATEGORY, FOCUS)

    return q


def _records_in_range(range_name):
    def q(spark, sf_dir):
        return op.records_in_range(_records(spark, sf_dir), FOCUS, range_name, AS_OF)

    return q


def count_in_range(spark, sf_dir):
    return op.count_in_range(spark, _records(spark, sf_dir), FOCUS, SUMMARY_RANGE, AS_OF)


def run_summary(spark, sf_dir):
    return op.run_summary(_records(spark, sf_dir), FOCUS)


def field_map(spark, sf_dir):
    recs = _records(spark, sf_dir)
    return as_field_map(recs.select(*RECORD_COLUMNS)).select(F.explode("fields").alias("key", "value"))


def topk_records_many(spark, sf_dir):
    return op.topk_records_by_category(_records(spark, sf_dir), "views", K_MANY, FOCUS)


def menu_topk_known(spark, sf_dir):
    """Menu entry 7 for a selection with unknown ids, which are refused."""
    videos = _untitled_videos(spark, sf_dir)
    return menu_query(spark, 7, videos, _cats(spark, sf_dir), CHOSEN_WITH_UNKNOWN, K_OVERALL)


def topk_counts(spark, sf_dir):
    """Display-ready records per focus category with the total."""
    return op.counts_with_total(spark, op.display_ready(_records(spark, sf_dir)), FOCUS)


def filtered_count(spark, sf_dir):
    lines = op.filter_records_by_category(_records(spark, sf_dir), SINGLE_CATEGORY)
    return lines.agg(F.count(F.lit(1)).alias("n_records"))


def single_line_titles(spark, sf_dir):
    """Titles that a line break splits, as one line each."""
    broken = F.concat("title", F.lit("\r\n"), "channel_title", F.lit("\n"), F.col("views").cast("string"))
    return _records(spark, sf_dir).select("video_id", single_line(broken).alias("line"))


def _via_files(spark: SparkSession, write, mode: str, query, trending_date_format: str) -> DataFrame:
    """``query`` over records read back from files that ``write`` puts into a
    folder. The result is checkpointed and the files are removed."""
    folder = scratch(spark, "trending-csv")
    write(folder)
    records = read_trending(spark, folder, mode=mode, trending_date_format=trending_date_format)
    result = query(records).checkpoint(eager=True)
    remove(spark, folder)
    return result


def _via_csv(spark: SparkSession, sf_dir: str, mode: str, query) -> DataFrame:
    """The adapter rows as trending CSV files, read back with the CSV
    source: the original input path end to end."""
    return _via_files(spark, lambda to: write_snapshot_csv(_records(spark, sf_dir), to), mode, query, "yyyy-MM-dd")


def rollup_videos_from_csv(spark, sf_dir):
    cats = _cats(spark, sf_dir)
    return _via_csv(spark, sf_dir, "csv", lambda r: op.rollup_videos(r, cats).select(*VIDEO_COLUMNS))


def rollup_videos_from_csv_lines(spark, sf_dir):
    cats = _cats(spark, sf_dir)
    return _via_csv(spark, sf_dir, "line", lambda r: op.rollup_videos(r, cats).select(*VIDEO_COLUMNS))


def sum_likes_dislikes_from_csv_lines(spark, sf_dir):
    cats = _cats(spark, sf_dir)
    return _via_csv(spark, sf_dir, "line", lambda r: op.sum_likes_dislikes_by_category(r, cats, FOCUS))


def dirty_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every adapter row as a CSV line (``value``) that a rule on the order
    key makes bad in one of nine ways, or leaves clean."""
    kind = F.col("l_orderkey") % DIRT
    title = F.col("title")
    at = lambda n, bad, good: F.when(kind == n, bad).otherwise(good)
    fields = [
        F.col("video_id"),
        F.col("trending_date").cast("string"),
        F.when(kind == 2, F.concat(F.lit('"'), title, F.lit(', with comma"')))
        .when(kind == 6, F.lit(""))
        .when(kind == 7, F.concat(F.lit('"say ""'), title, F.lit('"""')))
        .otherwise(title),
        F.col("channel_title"),
        at(8, F.lit("abc"), F.col("category_id").cast("string")),
        at(5, F.lit("1/6/2018"), F.concat(F.col("publish_date").cast("string"), F.lit("T00:00:00.000Z"))),
        F.lit("x"),
        at(3, F.lit("n/a"), F.col("views").cast("string")),
        at(4, F.lit("-5"), F.col("likes").cast("string")),
        F.col("dislikes").cast("string"),
        *[F.lit(v) for v in ("5", "thumb", "False", "False", "False", "text")],
    ]
    line = F.concat_ws(",", *fields)
    line = F.when(kind == 0, F.concat_ws(",", *fields[:4])).when(kind == 1, F.concat(line, F.lit(",extra"))).otherwise(line)
    # each file starts with the header: the first row of a task brings it
    first = F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) == 0
    lines = trending_from_tables(spark, sf_dir, keep=("l_orderkey",)).select(
        line.alias("line"), F.monotonically_increasing_id().alias("at")
    )
    return lines.select(F.explode(F.when(first, F.array(F.lit(HEADER_LINE), F.col("line"))).otherwise(F.array("line"))).alias("value"))


def _dirty(mode: str, query):
    def q(spark, sf_dir):
        cats = _cats(spark, sf_dir)
        return _via_files(
            spark, lambda to: dirty_lines(spark, sf_dir).write.text(to), mode, lambda r: query(spark, r, cats), "yyyy-MM-dd"
        )

    return q


def _rejected_by_reason(spark, records, cats):
    return rejected_records(records, METRICS, display=True).groupBy("reason").agg(F.count(F.lit(1)).alias("n_records"))


def _dated_by_category(spark, records, cats):
    dated = op.valid_publish_date(valid_records(records), YEAR)
    return dated.groupBy("category_id").agg(F.count(F.lit(1)).alias("n_records"))


DIRTY_QUERIES = {
    "dirty_rejected_by_reason": _dirty("csv", _rejected_by_reason),
    "dirty_run_summary": _dirty("csv", lambda spark, r, cats: op.run_summary(r, FOCUS, METRICS)),
    "dirty_run_summary_lines": _dirty("line", lambda spark, r, cats: op.run_summary(r, FOCUS, METRICS)),
    "dirty_rollup_videos": _dirty("csv", lambda spark, r, cats: op.rollup_videos(r, cats).select(*VIDEO_COLUMNS)),
    "dirty_rollup_videos_lines": _dirty("line", lambda spark, r, cats: op.rollup_videos(r, cats).select(*VIDEO_COLUMNS)),
    "dirty_filter_records": _dirty("csv", lambda spark, r, cats: op.filter_records_by_category(r, SINGLE_CATEGORY)),
    "dirty_dated_by_category": _dirty("csv", _dated_by_category),
}


QUERIES: dict[str, Query] = {
    "rollup_videos": rollup_videos,
    "list_categories": list_categories,
    "selected_categories": selected_categories,
    "unknown_categories": unknown_categories,
    "with_category": with_category,
    "count_videos_by_category": count_videos_by_category,
    "filter_videos_by_category": filter_videos_by_category,
    "topk_videos_by_category_views": _topk_by_category("views"),
    "topk_videos_by_category_likes": _topk_by_category("likes"),
    "topk_videos_by_category_dislikes": _topk_by_category("dislikes"),
    "topk_videos_views": _topk("views"),
    "topk_videos_likes": _topk("likes"),
    "topk_videos_dislikes": _topk("dislikes"),
    "topk_videos_views_year": _topk("views", YEAR),
    "topk_videos_likes_year": _topk("likes", YEAR),
    "topk_videos_dislikes_year": _topk("dislikes", YEAR),
    "count_records_by_category": count_records_by_category,
    "sum_views_by_category": sum_views_by_category,
    "sum_likes_dislikes_by_category": sum_likes_dislikes_by_category,
    "sort_records_by_views": sort_records_by_views,
    "filter_records_by_category": filter_records_by_category,
    "topk_records_by_category_views": _topk_records("views"),
    "topk_records_by_category_likes": _topk_records("likes"),
    **{name: _records_in_range(r) for name, r in RANGE_QUERIES.items()},
    "count_in_range": count_in_range,
    "run_summary": run_summary,
    "as_field_map": field_map,
    "rollup_videos_from_csv": rollup_videos_from_csv,
    "rollup_videos_from_csv_lines": rollup_videos_from_csv_lines,
    "sum_likes_dislikes_from_csv_lines": sum_likes_dislikes_from_csv_lines,
    "topk_records_by_category_views_many": topk_records_many,
    "menu_topk_videos_known": menu_topk_known,
    "topk_counts_with_total": topk_counts,
    "filtered_record_count": filtered_count,
    "single_line_titles": single_line_titles,
    **DIRTY_QUERIES,
}
