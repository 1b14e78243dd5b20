"""The record-grain standalone jobs, one function each.

They work on single snapshot rows (no rollup) of the five focus categories
(``FOCUS_IDS``) unless told otherwise, write their result with a
distributed writer, and return the run summary as a one-row DataFrame
(records read / malformed / usable / output / skipped).

The counts are observed while the result is written, in the same pass over
the input. Jobs with a range sort count in a pass of their own: their input
is read a second time for the sort's sample, which would be counted too.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from trendstats import operators as op
from trendstats.functions.columns import prefixed_line, record_csv_line
from trendstats.schema import FOCUS_IDS, RAW_COLUMNS, TRENDING_DATE_FORMAT
from trendstats.sinks import write_table, write_text_by_category
from trendstats.sources import read_categories, read_trending


def _inputs(spark, trending_path, categories_path, mode, trending_date_format=TRENDING_DATE_FORMAT):
    records = read_trending(spark, trending_path, mode=mode, trending_date_format=trending_date_format)
    cats = read_categories(spark, categories_path) if categories_path else None
    return records, cats


def _observed(df: DataFrame, columns) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return df.observe(seen, *columns), seen


def _summary(spark: SparkSession, seen: Observation) -> DataFrame:
    counts = seen.get
    names = list(counts)
    return spark.createDataFrame([tuple(int(counts[n]) for n in names)], ", ".join(f"{n} bigint" for n in names))


def _cats_or_empty(spark: SparkSession, cats: DataFrame | None) -> DataFrame:
    if cats is not None:
        return cats
    return spark.range(0).select(
        F.lit(None).cast("int").alias("category_id"), F.lit(None).cast("string").alias("title")
    )


def views_count(spark, trending_path, out_dir, categories_path=None, ids: Sequence[int] = FOCUS_IDS, mode="csv", trending_date_format=TRENDING_DATE_FORMAT):
    """Total views per focus category → ``(category,views)`` lines."""
    records, cats = _inputs(spark, trending_path, categories_path, mode, trending_date_format)
    records, seen = _observed(records, op.summary_columns(records, ids, metrics=("views",)))
    sums = op.sum_views_by_category(records, _cats_or_empty(spark, cats), ids, wide=True)
    write_table(sums.select(F.coalesce("category", F.col("category_id").cast("string")), "views"), out_dir, "tuple")
    return _summary(spark, seen)


def likes_count(spark, trending_path, out_dir, categories_path=None, ids: Sequence[int] = FOCUS_IDS, mode="csv", trending_date_format=TRENDING_DATE_FORMAT):
    """Total likes and dislikes per focus category → ``(category,likes,dislikes)``."""
    records, cats = _inputs(spark, trending_path, categories_path, mode, trending_date_format)
    records, seen = _observed(records, op.summary_columns(records, ids, metrics=("likes", "dislikes")))
    sums = op.sum_likes_dislikes_by_category(records, _cats_or_empty(spark, cats), ids, wide=True)
    write_table(
        sums.select(F.coalesce("category", F.col("category_id").cast("string")), "likes", "dislikes"), out_dir, "tuple"
    )
    return _summary(spark, seen)


def views_sort(spark, trending_path, out_dir, categories_path=None, ids: Sequence[int] = FOCUS_IDS, mode="csv", trending_date_format=TRENDING_DATE_FORMAT):
    """Focus records by views ascending → ``<category>: <record as CSV>``
    text lines (range-partitioned, part files in order)."""
    records, cats = _inputs(spark, trending_path, categories_path, mode, trending_date_format)
    rest = ["trending_date_text", *[c for c in RAW_COLUMNS if c not in op.RECORD_OUT]]
    ordered = op.sort_records_by_views(records, _cats_or_empty(spark, cats), ids, extra=rest)
    label = F.coalesce(F.col("category"), F.col("category_id").cast("string"))
    flags = {c: F.initcap(F.col(c).cast("string")) for c in ("comments_disabled", "ratings_disabled", "video_error_or_removed")}
    whole = ordered.withColumns({**flags, "trending_date": F.col("trending_date_text")})
    write_table(whole.select(prefixed_line(label, record_csv_line(*RAW_COLUMNS)).alias("value")), out_dir, "text")
    return op.run_summary(records, ids, metrics=("views",))


def category_count(spark, trending_path, categories_path=None, ids: Sequence[int] = FOCUS_IDS, mode="csv", trending_date_format=TRENDING_DATE_FORMAT):
    """Records per focus category (zero-filled) plus the run summary."""
    records, cats = _inputs(spark, trending_path, categories_path, mode, trending_date_format)
    records, seen = _observed(records, op.summary_columns(records, ids))
    counts = op.count_records_by_category(spark, records, _cats_or_empty(spark, cats), ids)
    # a row a focus id: kept, so that counts and summary come from one pass
    counts = spark.createDataFrame(counts.collect(), counts.schema)
    return counts, _summary(spark, seen)


def topk_records(spark, metric, k, trending_path, out_dir, ids: Sequence[int] = FOCUS_IDS, mode="csv", trending_date_format=TRENDING_DATE_FORMAT):
    """Top k records by ``metric`` per focus category → ``<n>: <line>`` text
    files per category; returns the display-ready record count per focus
    category with the total."""
    records, _ = _inputs(spark, trending_path, None, mode, trending_date_format)
    top = op.topk_records_by_category(records, metric, k, ids)
    write_text_by_category(top, out_dir)
    return op.counts_with_total(spark, op.display_ready(records), ids)


def date_range(
    spark,
    range_name,
    trending_path,
    out_dir,
    as_of: str | dt.date | None = None,
    ids: Sequence[int] = FOCUS_IDS,
    mode="csv",
    trending_date_format=TRENDING_DATE_FORMAT,
):
    """Focus records published in the range, numbered by publish date per
    category → ``<n>: <date - url - title>`` text per category; returns the
    per-category counts with the total row."""
    records, _ = _inputs(spark, trending_path, None, mode, trending_date_format)
    numbered = op.records_in_range(records, ids, range_name, as_of)
    write_text_by_category(numbered, out_dir)
    return op.count_in_range(spark, records, ids, range_name, as_of)


def filter_by_category(spark, category_id: int, trending_path, out_dir, mode="csv", trending_date_format=TRENDING_DATE_FORMAT):
    """One category's display lines → text directory; returns the count."""
    records, _ = _inputs(spark, trending_path, None, mode, trending_date_format)
    lines, seen = _observed(op.filter_records_by_category(records, category_id), [F.count(F.lit(1)).alias("n_records")])
    write_table(lines.select("line"), out_dir, "text")
    return _summary(spark, seen)
