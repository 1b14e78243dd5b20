"""Video rollup, menu entries and record jobs on the golden CSV."""

from __future__ import annotations

import datetime as dt

import pytest

from trendstats import operators as op
from trendstats.plans.menu import menu_query
from tests.fixtures import CATEGORY_ROWS

ALL_IDS = [c for c, _, _ in CATEGORY_ROWS]


@pytest.fixture(scope="module")
def videos(records, cats):
    return op.rollup_videos(records, cats).cache()


def test_rollup_values(videos):
    rows = {r.video_id: r for r in videos.collect()}
    assert sorted(rows) == ["v01", "v02", "v03", "v04", "v05", "v06", "v07", "v09", "v10", "v13"]
    assert (rows["v01"].views, rows["v01"].likes, rows["v01"].dislikes) == (1000, 40, 3)
    assert rows["v01"].trending_date == dt.date(2018, 2, 1)
    assert (rows["v02"].views, rows["v02"].likes, rows["v02"].title) == (2_000_001, 101, "Comma, twice")
    assert (rows["v03"].views, rows["v03"].likes) == (999, 7)
    assert (rows["v04"].views, rows["v04"].channel_title) == (50, "B, Inc")
    assert (rows["v05"].views, rows["v05"].likes) == (60, 6)
    assert rows["v06"].views == 4_000_000_000 and rows["v06"].likes == 16
    assert (rows["v07"].views, rows["v07"].likes) == (70, 9)
    assert rows["v07"].trending_date == dt.date(2018, 2, 2)
    assert rows["v09"].category is None and rows["v09"].views == 90
    assert rows["v10"].category == "Anime/Animation"
    assert rows["v13"].category == "Comedy" and rows["v13"].category_id == 23
    assert rows["v01"].url == "https://www.youtube.com/watch?v=v01"


def test_rollup_preserves_metric_sums(records, videos):
    from trendstats.schema import METRICS
    from trendstats.sources import valid_records

    valid = valid_records(records, metrics=METRICS, need_date=True)
    a = valid.agg(*[__import__("pyspark.sql.functions", fromlist=["sum"]).sum(m) for m in METRICS]).first()
    b = videos.agg(*[__import__("pyspark.sql.functions", fromlist=["sum"]).sum(m) for m in METRICS]).first()
    assert tuple(a) == tuple(b)


def test_count_by_category_keeps_same_titles_apart(spark, videos, cats):
    got = {r.category_id: r.n_videos for r in op.count_videos_by_category(spark, videos, cats, [23, 34, 10]).collect()}
    assert got == {23: 1, 34: 0, 10: 3}


def test_topk_overall(spark, videos, cats):
    top = menu_query(spark, 7, videos, cats, [0], k=3)
    assert [r.video_id for r in top.orderBy("rank").collect()] == ["v06", "v02", "v01"]


def test_topk_of_year(spark, videos, cats):
    top = menu_query(spark, 10, videos, cats, None, k=10, year=2018)
    got = [r.video_id for r in top.orderBy("rank").collect()]
    assert got == ["v06", "v02", "v01", "v13", "v10", "v07", "v05", "v04"]  # no v03 (2017), no v09 (unknown id)


def test_topk_zero_and_negative(spark, videos, cats):
    assert menu_query(spark, 7, videos, cats, None, k=0).count() == 0
    with pytest.raises(ValueError):
        menu_query(spark, 7, videos, cats, None, k=-1)


def test_topk_per_category(spark, videos, cats):
    top = menu_query(spark, 4, videos, cats, [10, 24], k=2)
    got = sorted((r.category_id, r.rank, r.video_id) for r in top.collect())
    assert got == [(10, 1, "v02"), (10, 2, "v01"), (24, 1, "v03"), (24, 2, "v04")]


def test_filter_videos(spark, videos, cats):
    got = [r.video_id for r in menu_query(spark, 3, videos, cats, [10]).collect()]
    assert got == ["v06", "v02", "v01"]


def test_record_topk_is_numeric(records):
    top = op.topk_records_by_category(records, "views", 2, [10])
    got = sorted((r.rank, r.line) for r in top.collect())
    assert [r for r, _ in got] == [1, 2]
    assert all("(v06)" in line and "views: 2000000000" in line and line.endswith("category: 10") for _, line in got)


def test_record_display_line(records):
    lines = [r.line for r in op.filter_records_by_category(records, 24).collect()]
    assert sorted(lines) == [
        "title: Chan comma (v04)\tdate: 02/28/2018\tviews: 50\tlikes: 5",
        "title: Comma, once (v03)\tdate: 12/31/2017\tviews: 999\tlikes: 7",
    ]


def test_sums_and_counts(spark, records, cats):
    views = {r.category_id: r.views for r in op.sum_views_by_category(records, cats, [10, 24, 27]).collect()}
    assert views == {10: 1000 + 2_000_001 + 4_000_000_000, 24: 1049, 27: 70}
    ld = {r.category_id: (r.likes, r.dislikes) for r in op.sum_likes_dislikes_by_category(records, cats, [27]).collect()}
    assert ld == {27: (17, 0)}  # the bad-views record still counts for likes
    counts = {r.category_id: r.n_records for r in op.count_records_by_category(spark, records, cats, [10, 27, 44]).collect()}
    assert counts == {10: 6, 27: 2, 44: 0}


def test_run_summary(records):
    s = op.run_summary(records, [10, 24, 25, 27, 28], metrics=("views",)).first()
    assert s.n_read == 18 and s.n_malformed == 2
    assert s.n_valid == 14  # minus width x2, bad category, bad views
    assert s.n_output == 11  # v01 x2, v02 x2, v03, v04, v05, v06 x2, v07 (good), v08
    assert s.n_read == s.n_output + s.n_skipped
    assert s.n_groups == 5


def test_selection_views(spark, cats):
    sel = [(r.position, r.category_id, r.title) for r in op.selected_categories(spark, [24, 99, 10, 24], cats).collect()]
    assert sorted(sel) == [(1, 24, "Entertainment"), (2, 10, "Music")]
    assert [r.category_id for r in op.unknown_categories(spark, [24, 99, 10], cats).collect()] == [99]
    first = op.list_categories(cats).first()
    assert (first.category_id, first.title) == (1, "Film & Animation")


def test_records_in_range(records):
    out = op.records_in_range(records, [10, 24, 25, 27, 28], "last-month", as_of="2018-03-31")
    got = sorted((r.category_id, r.rank, r.line) for r in out.collect())
    assert got == [
        (24, 1, "2018-02-28 - https://www.youtube.com/watch?v=v04 - title:Chan comma"),
        (25, 1, "2018-03-01 - https://www.youtube.com/watch?v=v05 - title:No description"),
    ]
