"""Properties over the adapter tables (sf0.001) and random inputs."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from trendstats import operators as op
from trendstats.schema import METRICS
from trendstats.sources import categories_from_tables, trending_from_tables, valid_records
from tests.conftest import SF_SMALL

IDS = (1, 2, 3, 5, 8, 13, 21)


@pytest.fixture(scope="module")
def tables(spark):
    records = trending_from_tables(spark, SF_SMALL).cache()
    cats = categories_from_tables(spark, SF_SMALL).cache()
    videos = op.rollup_videos(records, cats).cache()
    return records, cats, videos


def test_counts_add_up(spark, tables):
    records, cats, videos = tables
    per_cat = op.count_videos_by_category(spark, videos, cats, None).agg(F.sum("n_videos")).first()[0]
    known = op.in_categories(videos, None, cats).count()
    assert per_cat == known
    totals = {r.is_total: r.n_records for r in op.counts_with_total(spark, valid_records(records), IDS)
              .groupBy("is_total").agg(F.sum("n_records").alias("n_records")).collect()}
    assert totals[0] == totals[1] == op.in_categories(valid_records(records), IDS).count()


def test_global_topk_within_union_of_per_category(tables):
    _, _, videos = tables
    for metric in METRICS:
        top = {r.video_id for r in op.topk_videos(videos, metric, 7, IDS).collect()}
        per = {r.video_id for r in op.topk_videos_by_category(videos, metric, 7, IDS).collect()}
        assert top <= per


def test_rollup_preserves_sums_and_videos(tables):
    records, _, videos = tables
    valid = valid_records(records, metrics=METRICS, need_date=True)
    a = valid.agg(*[F.sum(m) for m in METRICS], F.countDistinct("video_id")).first()
    b = videos.agg(*[F.sum(m) for m in METRICS], F.count("*")).first()
    assert tuple(a) == tuple(b)


def test_representative_is_earliest_snapshot(tables):
    records, _, videos = tables
    first_day = records.groupBy("video_id").agg(F.min("trending_date").alias("d"))
    mism = videos.join(first_day, "video_id").where(F.col("trending_date") != F.col("d")).count()
    assert mism == 0


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    rows=st.lists(st.tuples(st.integers(0, 3), st.integers(-5, 5), st.sampled_from(["a", "b", "c"])), max_size=60),
    parts=st.integers(1, 7),
)
def test_number_within_random(spark, rows, parts):
    df = spark.createDataFrame(rows, "g int, k int, s string")
    order = [F.asc("k"), F.desc("s")]
    got = sorted(tuple(r) for r in op.number_within(df, ["g"], order, partitions=parts).collect())
    want = sorted(
        tuple(r)
        for r in df.withColumn("rank", F.row_number().over(Window.partitionBy("g").orderBy(*order)).cast("bigint"))
        .collect()
    )
    assert got == want
