"""Aggregations: the video rollup and the category counts and sums.

All of them are one ``groupBy`` each: partial aggregation before the
shuffle (so a hot video or category collapses to one row per map task
before it moves), final aggregation after it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendstats.functions.columns import watch_url
from trendstats.operators.joins import in_categories, selection, with_category
from trendstats.operators.select import published_since
from trendstats.schema import METRICS, VIDEO_COLUMNS
from trendstats.sources.trending import valid_records, validity

# Order that picks a video's representative snapshot: earliest trending
# day (unknown days last), then the other fields as tie-breaks.
_PICK_FIELDS = ("title", "channel_title", "category_id", "publish_date")


def exact_sum(column: str, wide: bool = False) -> Column:
    """Sum of a non-negative bigint column: a bigint, or with ``wide`` a
    decimal(38,0) that no total of bigints overflows. The wide sum adds the
    low and the high 32 bits apart (two longs in a hash aggregate; they hold
    2^31 rows of the largest values in each task before the decimals meet)."""
    if not wide:
        return F.sum(column)
    low = F.col(column).bitwiseAND(F.lit((1 << 32) - 1)).cast("decimal(10,0)")
    high = F.shiftrightunsigned(F.col(column), 32).cast("decimal(10,0)")
    total = F.sum(high).cast("decimal(28,0)") * F.lit(1 << 32).cast("decimal(10,0)")
    return (total.cast("decimal(38,0)") + F.sum(low).cast("decimal(38,0)")).cast("decimal(38,0)")


def video_parts(records: DataFrame, wide: bool = False) -> DataFrame:
    """One mergeable row per video of ``records``: the metric sums over its
    valid snapshots and ``_pick``, the representative snapshot as a struct
    whose minimum is the earliest one."""
    valid = valid_records(records, metrics=METRICS, need_date=True)
    # the trending date as it was written, where the source keeps it
    text = [c for c in ("trending_date_text",) if c in records.columns]
    pick = F.min(
        F.struct(
            F.col("trending_date").isNull().alias("_late"),
            F.col("trending_date"),
            *[F.col(c) for c in (*text, *_PICK_FIELDS)],
        )
    ).alias("_pick")
    return valid.groupBy("video_id").agg(*[exact_sum(m, wide).alias(m) for m in METRICS], pick)


def videos_of_parts(parts: DataFrame) -> DataFrame:
    """``video_parts`` rows as video rows."""
    text = [c for c in ("trending_date_text",) if c in parts.schema["_pick"].dataType.names]
    return parts.select(
        "video_id",
        F.col("_pick.title").alias("title"),
        F.col("_pick.category_id").alias("category_id"),
        F.col("_pick.publish_date").alias("publish_date"),
        F.col("_pick.trending_date").alias("trending_date"),
        F.col("_pick.channel_title").alias("channel_title"),
        *METRICS,
        watch_url("video_id").alias("url"),
        *[F.col(f"_pick.{c}").alias(c) for c in text],
    )


def rollup_videos(records: DataFrame, cats: DataFrame | None = None, wide: bool = False) -> DataFrame:
    """One row per video: views, likes and dislikes summed over all its
    valid snapshots; title, channel, category, publish and trending date
    from its earliest snapshot; the watch URL.

    A snapshot is used when its metrics are non-negative integers and its
    publish date parses; a bad snapshot is left out, its video stays.
    With ``cats``, adds the category title (``category``). ``wide`` gives the
    sums as decimal(38,0), for totals past 64 bits.
    """
    out = videos_of_parts(video_parts(records, wide))
    if cats is None:
        return out
    return with_category(out, cats).select(*VIDEO_COLUMNS, *[c for c in ("trending_date_text",) if c in out.columns])


def count_videos_by_category(
    spark: SparkSession, videos: DataFrame, cats: DataFrame, ids: Sequence[int] | None = None
) -> DataFrame:
    """Videos per chosen category (all dimension ids when ``ids`` is None);
    a chosen category without videos counts 0. Unknown ids are not listed."""
    dim = cats.select("category_id", F.col("title").alias("category"))
    if ids is not None:
        dim = dim.join(selection(spark, ids).select("category_id"), "category_id", "left_semi")
    chosen = in_categories(videos.select("category_id"), ids, cats)
    counts = chosen.groupBy("category_id").agg(F.count(F.lit(1)).alias("n_videos"))
    return dim.join(counts, "category_id", "left").select(
        "category_id", "category", F.coalesce(F.col("n_videos"), F.lit(0)).cast("bigint").alias("n_videos")
    )


def count_records_by_category(
    spark: SparkSession, records: DataFrame, cats: DataFrame, ids: Sequence[int]
) -> DataFrame:
    """Valid records per focus category, zero for a focus id without any."""
    valid = in_categories(valid_records(records), ids)
    # At most len(ids) rows: the broadcast is bounded by the parameter.
    counts = valid.groupBy("category_id").agg(F.count(F.lit(1)).alias("n_records"))
    sel = with_category(selection(spark, ids).select("category_id"), cats)
    return sel.join(F.broadcast(counts), "category_id", "left").select(
        "category_id", "category", F.coalesce(F.col("n_records"), F.lit(0)).cast("bigint").alias("n_records")
    )


def sum_views_by_category(records: DataFrame, cats: DataFrame, ids: Sequence[int], wide: bool = False) -> DataFrame:
    """Total views per focus category (records with a usable view count);
    ``wide`` as in ``exact_sum``."""
    valid = in_categories(valid_records(records, metrics=("views",)), ids)
    sums = valid.groupBy("category_id").agg(exact_sum("views", wide).alias("views"))
    return with_category(sums, cats).select("category_id", "category", "views")


def sum_likes_dislikes_by_category(
    records: DataFrame, cats: DataFrame, ids: Sequence[int], wide: bool = False
) -> DataFrame:
    """Total likes and dislikes per focus category; ``wide`` as in ``exact_sum``."""
    valid = in_categories(valid_records(records, metrics=("likes", "dislikes")), ids)
    sums = valid.groupBy("category_id").agg(*[exact_sum(m, wide).alias(m) for m in ("likes", "dislikes")])
    return with_category(sums, cats).select("category_id", "category", "likes", "dislikes")


def counts_with_total(spark: SparkSession, records: DataFrame, ids: Sequence[int]) -> DataFrame:
    """Rows per focus category (zero for a focus id without any) plus the
    grand total (``is_total`` = 1, ``category_id`` null). ``records`` is
    already filtered; the rollup runs on at most len(ids) counts, so the
    total row exists even when nothing matched."""
    counts = in_categories(records, ids).groupBy("category_id").agg(F.count(F.lit(1)).alias("n"))
    # At most len(ids) rows: the broadcast is bounded by the parameter.
    per_id = selection(spark, ids).select("category_id").join(F.broadcast(counts), "category_id", "left")
    return per_id.rollup("category_id").agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_records"),
        F.grouping_id().cast("int").alias("is_total"),
    )


def count_in_range(
    spark: SparkSession, records: DataFrame, ids: Sequence[int], range_name: str, as_of: str | dt.date | None = None
) -> DataFrame:
    """Records per focus category published in the range, with the total."""
    valid = published_since(valid_records(records, need_date=True), range_name, as_of)
    return counts_with_total(spark, valid, ids)


def summary_columns(records: DataFrame, ids: Sequence[int], metrics: Sequence[str] = ()) -> list[Column]:
    """The run counts as plain aggregates (usable in ``observe`` too):
    records read, malformed (wrong width), usable for a job needing
    ``metrics``, and of those in the focus categories; ``n_skipped`` = read −
    (usable and in focus); ``n_groups`` = focus categories with at least one
    usable record (the output groups of the per-category sums)."""
    ok = validity(records, metrics)
    malformed = F.col("_malformed") if "_malformed" in records.columns else F.lit(False)
    focus = sorted({int(i) for i in ids})
    in_focus = ok & F.coalesce(F.col("category_id").isin(focus), F.lit(False))
    groups = F.lit(0).cast("bigint")
    for i in focus:
        groups = groups + F.coalesce(F.max((in_focus & F.coalesce(F.col("category_id") == i, F.lit(False))).cast("bigint")), F.lit(0))
    return [
        F.count(F.lit(1)).alias("n_read"),
        F.count_if(malformed).alias("n_malformed"),
        F.count_if(ok).alias("n_valid"),
        F.count_if(in_focus).alias("n_output"),
        F.count_if(~in_focus).alias("n_skipped"),
        groups.alias("n_groups"),
    ]


def run_summary(records: DataFrame, ids: Sequence[int], metrics: Sequence[str] = ()) -> DataFrame:
    """One row of run counts, see ``summary_columns``."""
    return records.agg(*summary_columns(records, ids, metrics))
