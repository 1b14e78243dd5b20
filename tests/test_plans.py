"""Plan shapes that matter at scale."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from trendstats import operators as op
from trendstats.plans.catalog import QUERIES
from tests.conftest import SF_SMALL


def plan(df, capsys, mode="formatted"):
    capsys.readouterr()
    df.explain(mode)
    return capsys.readouterr().out


def test_global_topk_is_take_ordered(spark, capsys):
    p = plan(QUERIES["topk_videos_views"](spark, SF_SMALL), capsys)
    assert "TakeOrderedAndProject" in p
    assert "rangepartitioning" not in p.lower()  # no full sort


def test_topk_per_category_limits_before_shuffle(spark, capsys):
    p = plan(QUERIES["topk_videos_by_category_views"](spark, SF_SMALL), capsys, "simple")
    assert p.count("WindowGroupLimit") >= 2  # partial before the exchange, final after


def test_rollup_single_exchange(spark, capsys):
    p = plan(QUERIES["rollup_videos"](spark, SF_SMALL), capsys, "simple")
    assert p.count("Exchange hashpartitioning") == 1
    assert "hashpartitioning(video_id" in p


def test_scan_prunes_columns(spark, capsys):
    p = plan(QUERIES["sum_views_by_category"](spark, SF_SMALL), capsys)
    lineitem_schema = [line for line in p.splitlines() if "ReadSchema" in line and "l_partkey" in line][0]
    assert "l_quantity" not in lineitem_schema and "l_linenumber" not in lineitem_schema


def test_clean_table_pushdown_and_pruning(spark, records, workdir, capsys):
    from trendstats.sinks import write_clean_table
    from trendstats.sources import read_clean_table, valid_records

    path = os.path.join(workdir, "clean")
    write_clean_table(valid_records(records).drop("_malformed"), path)
    clean = read_clean_table(spark, path)
    q = op.in_categories(clean, [10, 24]).where("publish_date >= DATE'2018-01-01'").select("video_id", "views")
    p = plan(q, capsys)
    assert "PartitionFilters: [category_id" in p and "IN (10,24)]" in p
    assert "PushedFilters: [IsNotNull(publish_date), GreaterThanOrEqual(publish_date" in p
    assert "ReadSchema: struct<video_id:string,publish_date:date,views:bigint>" in p
    assert sorted(r.video_id for r in q.collect()) == ["v01", "v01", "v02", "v02", "v04", "v06", "v06"]


def test_valid_records_pushes_its_tests_down(spark, records, workdir, capsys):
    from trendstats.sources import valid_records

    path = os.path.join(workdir, "flat")
    valid_records(records).drop("_malformed").write.parquet(path)
    p = plan(valid_records(spark.read.parquet(path), metrics=("views",)), capsys)
    pushed = next(line for line in p.splitlines() if "PushedFilters" in line)
    assert "IsNotNull(video_id)" in pushed and "GreaterThanOrEqual(views,0)" in pushed


def test_dimension_broadcast_is_size_checked(spark, cats, capsys):
    big = spark.range(50).select(F.col("id").cast("int").alias("category_id"))
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    try:
        spark.conf.set(limit, "-1")  # no dimension is small enough
        assert "Broadcast" not in plan(op.with_category(big, cats), capsys, "simple")
    finally:
        spark.conf.set(limit, before)


def test_topk_within_never_meets_a_whole_group(spark, capsys):
    df = spark.range(1000).select(F.lit(1).alias("g"), "id")
    for k in (5, 999):
        p = plan(op.topk_within(df, ["g"], [F.asc("id")], k), capsys, "simple")
        assert "_level" in p and p.count("WindowGroupLimit") >= 2  # tests/test_selection.py counts the rows
    got = op.topk_within(df, ["g"], [F.asc("id")], 5000)
    assert sorted((r.rank, r.id) for r in got.collect()) == [(i + 1, i) for i in range(1000)]


def test_clean_table_merges_small_files(spark, records, workdir):
    import glob

    from trendstats.sinks import write_clean_table
    from trendstats.sources import valid_records

    path = os.path.join(workdir, "clean_merged")
    rows = valid_records(records).drop("_malformed").repartition(8)
    write_clean_table(rows, path)
    categories = rows.select("category_id").distinct().count()
    assert len(glob.glob(os.path.join(path, "*", "*.parquet"))) == categories
