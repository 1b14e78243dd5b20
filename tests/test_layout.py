"""Layouts: no exchange on bucketed tables, few rows read of dated ones, one
pass for both routes, pages of ranked lists."""

from __future__ import annotations

import datetime as dt
import glob
import json
import uuid

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from trendstats import operators as op
from trendstats.plans import stored
from trendstats.schema import METRICS
from trendstats.sinks import (
    bucket_count,
    layout,
    read_ranks,
    read_routed,
    write_bucketed_table,
    write_dated_table,
    write_ranked_list,
    write_routed,
)
from trendstats.sources import read_trending, rejected_records, trending_from_tables, valid_records

TODAY = dt.date(2018, 6, 30)


def rows(df):
    return sorted(map(repr, map(tuple, df.collect())))


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def scanned(df) -> tuple[int, int]:
    """(files, rows) that the scans of a query have read."""
    df.collect()
    todo, files, n = [df._jdf.queryExecution().executedPlan()], 0, 0
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(node.plan())
        else:
            if kind == "FileSourceScanExec":
                files += node.metrics().get("numFiles").get().value()
                n += node.metrics().get("numOutputRows").get().value()
            children = node.children()
            todo += [children.apply(i) for i in range(children.size())]
    return files, n


def records_over_time(spark, n=50_000, days=1_000):
    hot = F.col("id") % 3 == 0
    return spark.range(0, n, 1, 4).select(
        F.concat(F.lit("v"), (F.col("id") % 5_000).cast("string")).alias("video_id"),
        F.lit(TODAY).alias("trending_date"),
        F.concat(F.lit("title "), F.col("id").cast("string")).alias("title"),
        F.lit("c").alias("channel_title"),
        F.when(hot, 10).otherwise((F.col("id") % 4).cast("int")).alias("category_id"),
        F.date_sub(F.lit(TODAY), F.pmod(F.xxhash64("id"), F.lit(days)).cast("int")).alias("publish_date"),
        F.col("id").alias("views"), F.col("id").alias("likes"), F.col("id").alias("dislikes"),
    )


@pytest.fixture
def table(spark):
    names = []

    def make():
        names.append("t_" + uuid.uuid4().hex)
        return names[-1]

    yield make
    for n in names:
        spark.sql(f"DROP TABLE IF EXISTS {n}")


def test_rollup_and_join_of_bucketed_tables_need_no_exchange(spark, tmp_path, table):
    records = trending_from_tables(spark, SF_SMALL)
    full = op.rollup_videos(records)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        snapshots = write_bucketed_table(records, table(), 8, str(tmp_path / "records"))
        rolled = op.rollup_videos(snapshots)
        assert rows(rolled) == rows(full)
        assert "Exchange" not in final_plan(rolled)
        videos = write_bucketed_table(rolled, table(), 8, str(tmp_path / "videos"))
        joined = snapshots.select("video_id", "trending_date").join(videos.select("video_id", "views"), "video_id")
        assert "Exchange" not in final_plan(joined)
        assert rows(joined) == rows(records.select("video_id", "trending_date").join(full.select("video_id", "views"), "video_id"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_buckets_grow_with_the_rows(spark):
    assert [bucket_count(spark.range(n), 8, 100) for n in (0, 1, 800, 801, 10_000)] == [8, 8, 8, 9, 100]


def test_bucketed_rollup_takes_buckets_by_rows(spark, monkeypatch):
    used = []
    monkeypatch.setattr(layout, "BUCKET_ROWS", 100)
    monkeypatch.setattr(stored.sinks, "write_bucketed_table", lambda df, name, buckets, path: used.append(buckets) or write_bucketed_table(df, name, buckets, path))
    got = stored.rollup_videos_bucketed(spark, SF_SMALL)
    records = trending_from_tables(spark, SF_SMALL)
    assert used == [max(stored.BUCKETS, -(-records.count() // 100))] and used[0] > stored.BUCKETS
    assert got.count() == op.rollup_videos(records).count()


def test_a_last_week_query_reads_few_rows(spark, tmp_path):
    df = records_over_time(spark)
    write_dated_table(df, str(tmp_path), partitions=12, row_group_bytes=64 << 10)
    stored = spark.read.parquet(str(tmp_path))
    for name, share in (("last-week", 0.10), ("last-month", 0.20)):
        query = op.published_since(stored, name, TODAY).select("video_id", "category_id", "publish_date", "views")
        want = op.published_since(df, name, TODAY)
        assert rows(query) == rows(want.select("video_id", "category_id", "publish_date", "views"))
        assert scanned(query)[1] <= share * 50_000
    files = glob.glob(f"{tmp_path}/category_id=10/*.parquet")
    assert len(files) > 1  # the hot category is split


def test_routes_in_one_scan(spark, golden_csv, tmp_path):
    records = read_trending(spark, golden_csv)
    counts = write_routed(records, str(tmp_path / "r"), METRICS, display=True)
    accepted, rejected = (read_routed(spark, str(tmp_path / "r"), r) for r in ("accepted", "rejected"))
    assert rows(accepted) == rows(valid_records(records, METRICS, display=True))
    want = rejected_records(records, METRICS, display=True)
    assert rows(rejected.select(want.columns)) == rows(want)
    by_reason = {r.reason: r["count"] for r in want.groupBy("reason").count().collect()}
    assert {k: v for k, v in counts.items() if v and not k.startswith("n_")} == by_reason
    assert counts["n_read"] == records.count() and counts["n_accepted"] == accepted.count()
    with pytest.raises(ValueError):
        read_routed(spark, str(tmp_path / "r"), "other")


def test_routed_write_scans_its_input_once(tmp_path):
    """The event log of a session of its own: one scan reads the rows."""
    import subprocess
    import sys

    script = f"""
from pyspark.sql import SparkSession
s = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.eventLog.enabled", "true")
     .config("spark.eventLog.dir", "file://{tmp_path}/log").config("spark.eventLog.compress", "false")
     .config("spark.eventLog.rolling.enabled", "false").getOrCreate())
from trendstats.sinks import write_routed
from trendstats.sources import read_trending
read = read_trending(s, "{tmp_path}/in.csv")
print(write_routed(read, "{tmp_path}/out", ("views",)))
s.stop()
"""
    from tests.fixtures import GOLDEN_CSV

    (tmp_path / "in.csv").write_text(GOLDEN_CSV)
    (tmp_path / "log").mkdir()
    import os

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", script], check=True, cwd=str(tmp_path), env={**os.environ, "PYTHONPATH": root}, timeout=300, capture_output=True)
    (log,) = glob.glob(f"{tmp_path}/log/*")
    ends = [json.loads(line) for line in open(log) if '"SparkListenerTaskEnd"' in line]
    read = [e["Task Metrics"]["Input Metrics"]["Records Read"] for e in ends]
    assert len([n for n in read if n]) == 1


@pytest.mark.parametrize("partitions", [1, 9])
def test_pages_of_a_ranked_list(spark, tmp_path, partitions):
    df = records_over_time(spark, 30_000).select("category_id", "video_id", "views")
    order = [F.desc("views"), F.asc("video_id")]
    write_ranked_list(df, str(tmp_path), ["category_id"], order, partitions=partitions)
    want = {}
    for r in sorted(df.collect(), key=lambda r: (-r.views, r.video_id)):
        want.setdefault(r.category_id, []).append((r.video_id, r.views))
    for g, first, last in ((10, 1, 3), (10, 5_000, 5_100), (1, len(want[1]) - 2, len(want[1]) + 50), (3, 1, 10**9), (10, 10**8, 10**9), (99, 1, 5)):
        page = read_ranks(spark, str(tmp_path), {"category_id": g}, first, last)
        got = {r["rank"]: (r.video_id, r.views) for r in page.collect()}
        assert got == {i + 1: x for i, x in enumerate(want.get(g, [])) if first <= i + 1 <= last}
    if partitions > 1:
        page = read_ranks(spark, str(tmp_path), {"category_id": 10}, 5_000, 5_100)
        assert 1 <= scanned(page)[0] <= 2
