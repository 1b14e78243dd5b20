"""The stored rollup: batches merge to the full rollup, replays change
nothing, a merge touches its own buckets only."""

from __future__ import annotations

import datetime as dt
import glob
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from trendstats import operators as op
from trendstats.operators import incremental

DAYS = [dt.date(2018, 1, d) for d in (1, 2, 3, 4)]


def snapshots(spark, n=4_000, videos=300):
    day = F.date_add(F.lit(DAYS[0]), (F.col("id") % len(DAYS)).cast("int"))
    return spark.range(n).select(
        F.concat(F.lit("v"), (F.xxhash64("id") % videos).cast("string")).alias("video_id"),
        F.when(F.col("id") % 41 != 0, day).alias("trending_date"),
        F.concat(F.lit("t"), (F.col("id") % 13).cast("string")).alias("title"),
        F.lit("c").alias("channel_title"),
        (F.col("id") % 5).cast("int").alias("category_id"),
        F.when(F.col("id") % 17 != 0, F.lit(dt.date(2017, 12, 31))).alias("publish_date"),
        (F.col("id") - 3).alias("views"),
        F.lit(1).cast("bigint").alias("likes"),
        F.lit(0).cast("bigint").alias("dislikes"),
    )


def rows(df):
    return sorted(map(repr, map(tuple, df.collect())))


def day(df, d):
    return df.where(F.col("trending_date") == F.lit(d)) if d else df.where("trending_date is null")


def test_merged_days_equal_the_full_rollup_in_any_order(spark, tmp_path):
    df = snapshots(spark)
    full = rows(op.rollup_videos(df))
    for at, order in enumerate(([*DAYS, None], [None, *reversed(DAYS)])):
        path = str(tmp_path / str(at))
        for d in order:
            assert incremental.merge_batch(spark, path, day(df, d), str(d), buckets=16)
        assert rows(incremental.read_videos(spark, path)) == full


def test_a_replayed_day_changes_nothing(spark, tmp_path):
    df, path = snapshots(spark), str(tmp_path)
    for d in DAYS[:2]:
        incremental.merge_batch(spark, path, day(df, d), str(d), buckets=8)
    before, files = rows(incremental.read_videos(spark, path)), sorted(glob.glob(f"{path}/**/*.parquet", recursive=True))
    assert incremental.merge_batch(spark, path, day(df, DAYS[0]), str(DAYS[0])) == []
    assert rows(incremental.read_videos(spark, path)) == before
    assert sorted(glob.glob(f"{path}/**/*.parquet", recursive=True)) == files
    assert incremental.merged_batches(spark, path) == [str(d) for d in DAYS[:2]]


def test_a_merge_writes_only_its_videos_buckets(spark, tmp_path):
    df, path = snapshots(spark), str(tmp_path)
    incremental.merge_batch(spark, path, day(df, DAYS[0]), "all", buckets=32)
    one = df.where("video_id = 'v7'")
    bucket = one.select(incremental.bucket_of("video_id", 32)).first()[0]
    assert incremental.merge_batch(spark, path, one, "one") == [bucket]
    assert [os.path.basename(d) for d in glob.glob(f"{path}/parts/version=2/bucket=*")] == [f"bucket={bucket}"]
    both = day(df, DAYS[0]).unionByName(one)
    assert rows(incremental.read_videos(spark, path)) == rows(op.rollup_videos(both))


def test_a_merge_that_died_before_its_commit_is_not_seen(spark, tmp_path):
    df, path = snapshots(spark), str(tmp_path)
    incremental.merge_batch(spark, path, day(df, DAYS[0]), "first", buckets=4)
    before = rows(incremental.read_videos(spark, path))
    # files of version 2 without a committed manifest
    op.rollup_videos(df).withColumn("bucket", F.lit(0)).write.partitionBy("bucket").parquet(f"{path}/parts/version=2")
    os.makedirs(f"{path}/manifest/version=3")
    assert rows(incremental.read_videos(spark, path)) == before
    incremental.merge_batch(spark, path, day(df, DAYS[1]), "second")
    want = rows(op.rollup_videos(df.where(F.col("trending_date").isin(DAYS[:2]))))
    assert rows(incremental.read_videos(spark, path)) == want


def test_vacuum_keeps_the_current_files(spark, tmp_path):
    df, path = snapshots(spark), str(tmp_path)
    for d in DAYS:
        incremental.merge_batch(spark, path, day(df, d), str(d), buckets=4)
    before = rows(incremental.read_videos(spark, path))
    assert incremental.vacuum(spark, path)
    assert len(glob.glob(f"{path}/parts/version=*/bucket=*")) == 4
    assert len(glob.glob(f"{path}/manifest/version=*")) == 1
    assert rows(incremental.read_videos(spark, path)) == before
    assert incremental.merge_batch(spark, path, day(df, DAYS[0]), str(DAYS[0])) == []


def test_an_empty_batch_counts_as_merged_and_an_empty_state_is_refused(spark, tmp_path):
    path = str(tmp_path)
    with pytest.raises(ValueError):
        incremental.read_videos(spark, path)
    assert incremental.merge_batch(spark, path, snapshots(spark, 0), "none") == []
    assert incremental.merged_batches(spark, path) == ["none"]
    with pytest.raises(ValueError):
        incremental.read_videos(spark, path)


def test_totals_past_64_bits_come_out_whole(spark, tmp_path):
    top = (1 << 63) - 1
    df = snapshots(spark, 90, 1).where("views >= 0 and publish_date is not null").withColumn("views", F.lit(top))
    n = df.count()
    assert op.rollup_videos(df, wide=True).first()["views"] == Decimal(top * n)
    cats = spark.createDataFrame([(i, f"c{i}") for i in range(5)], "category_id int, title string")
    sums = op.sum_views_by_category(df, cats, [0, 1, 2, 3, 4], wide=True)
    assert sum(r["views"] for r in sums.collect()) == Decimal(top * n)
    likes = op.sum_likes_dislikes_by_category(df.withColumn("likes", F.lit(top)), cats, [0, 1, 2, 3, 4], wide=True)
    assert sum(r["likes"] for r in likes.collect()) == Decimal(top * n)
    for d in [*DAYS, None]:
        incremental.merge_batch(spark, str(tmp_path), day(df, d), str(d), buckets=2, wide=True)
    assert incremental.read_videos(spark, str(tmp_path)).first()["views"] == Decimal(top * n)
    narrow = snapshots(spark)
    wide = op.rollup_videos(narrow, wide=True).select("video_id", *[F.col(m).cast("bigint") for m in ("views", "likes", "dislikes")])
    assert rows(wide) == rows(op.rollup_videos(narrow).select("video_id", "views", "likes", "dislikes"))
