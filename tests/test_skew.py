"""A hot key (a third of all rows) is pre-aggregated before it moves."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from trendstats import operators as op


def snapshots(spark, n=30000):
    # every third row belongs to the same video and category
    hot = F.col("id") % 3 == 0
    return spark.range(n).select(
        F.when(hot, F.lit("hot")).otherwise(F.concat(F.lit("v"), (F.col("id") % 997).cast("string"))).alias("video_id"),
        F.date_add(F.lit(dt.date(2018, 1, 1)), (F.col("id") % 50).cast("int")).alias("trending_date"),
        F.concat(F.lit("t"), (F.col("id") % 7).cast("string")).alias("title"),
        F.lit("c").alias("channel_title"),
        F.when(hot, F.lit(10)).otherwise((F.col("id") % 5).cast("int")).alias("category_id"),
        F.lit(dt.date(2017, 12, 31)).alias("publish_date"),
        F.col("id").alias("views"),
        F.lit(1).cast("bigint").alias("likes"),
        F.lit(0).cast("bigint").alias("dislikes"),
    )


def test_hot_video_rollup_is_exact(spark):
    df = snapshots(spark).repartition(16)
    videos = op.rollup_videos(df)
    hot = videos.where("video_id = 'hot'").first()
    assert hot.likes == 10000
    assert hot.views == sum(range(0, 30000, 3))
    assert hot.trending_date == dt.date(2018, 1, 1) and hot.title == "t0"  # earliest day, then smallest title


def test_partial_aggregation_before_shuffle(spark, capsys):
    videos = op.rollup_videos(snapshots(spark))
    capsys.readouterr()
    videos.explain("simple")
    plan = capsys.readouterr().out
    lines = plan.splitlines()
    exchange = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning(video_id" in line)
    below = "\n".join(lines[exchange:])
    assert "partial_sum" in below and "partial_min" in below


def test_hot_category_topk(spark):
    videos = op.rollup_videos(snapshots(spark).repartition(16))
    top = op.topk_videos_by_category(videos, "views", 3, [10, 1])
    got = {(r.category_id, r.rank): r.video_id for r in top.collect()}
    assert got[(10, 1)] == "hot"
    assert sorted(k for k in got if k[0] == 1) == [(1, 1), (1, 2), (1, 3)]
