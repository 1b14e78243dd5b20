"""CSV and JSON sources on the hand-made golden inputs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from trendstats.schema import METRICS
from trendstats.sources import as_field_map, read_trending, rejected_records, valid_records


def ids_of(df):
    return sorted(r.video_id for r in df.select("video_id").collect())


def test_csv_reads_every_row_and_flags_width(records):
    assert records.count() == 18
    bad = records.where("_malformed").select("video_id").collect()
    assert sorted(r.video_id for r in bad) == ["v11", "v12"]


def test_malformed_stays_malformed_when_few_columns_are_read(spark, golden_csv):
    # Column pruning would otherwise let the short row through.
    df = read_trending(spark, golden_csv)
    assert valid_records(df).select("category_id").count() == 15  # v14 has no numeric category
    assert df.where("_malformed").select("video_id").count() == 2


def test_quotes_and_commas(records):
    rows = {r.video_id: r for r in records.where("not _malformed").collect()}
    assert rows["v02"].title == "Comma, twice"
    assert rows["v04"].channel_title == "B, Inc"
    assert rows["v03"].description == 'a "quoted" desc, with comma'
    assert rows["v05"].description is None  # empty last field kept in csv mode


def test_rollup_rejects(records):
    rej = rejected_records(records, metrics=METRICS, need_date=True)
    got = sorted((r.video_id, r.trending_date_text, r.reason) for r in rej.collect())
    assert got == [
        ("v07", "18.01.02", "views"),
        ("v08", "18.01.02", "publish_date"),
        ("v11", "18.01.02", "malformed"),
        ("v12", "18.01.02", "malformed"),
        ("v14", "18.01.02", "category_id"),
    ]
    ok = valid_records(records, metrics=METRICS, need_date=True)
    assert ok.count() + rej.count() == records.count()


def test_typed_values(records):
    r = records.where("video_id = 'v06'").orderBy("trending_date").first()
    assert r.views == 2_000_000_000 and r.category_id == 10
    assert r.publish_date == dt.date(2018, 1, 5)
    assert r.trending_date == dt.date(2018, 2, 1)  # 18.01.02 is yy.dd.MM
    assert r.comments_disabled is False


def test_line_mode_token_counts(spark, golden_csv):
    df = read_trending(spark, golden_csv, mode="line")
    assert df.count() == 18  # header dropped
    bad = sorted(r.video_id for r in df.where("_malformed").collect())
    assert bad == ["v05", "v11", "v12"]  # v05 has an empty last field
    v02 = df.where("video_id = 'v02'").first()
    assert v02.title == "Comma, twice"
    v03 = df.where("video_id = 'v03'").first()
    assert v03.description == "a quoted desc, with comma"  # every quote deleted


def test_directory_and_glob_paths(spark, golden_csv):
    import os

    d = os.path.dirname(golden_csv)
    assert read_trending(spark, os.path.join(d, "*.csv")).count() == 18


def test_field_map(records):
    m = as_field_map(records.where("video_id = 'v04'"), ["video_id", "channel_title", "views"]).first().fields
    assert m == {"video_id": "v04", "channel_title": "B, Inc", "views": "50"}


def test_categories(cats):
    rows = {r.category_id: r for r in cats.collect()}
    assert len(rows) == 32
    assert rows[23].title == rows[34].title == "Comedy"
    assert rows[31].title == "Anime/Animation" and rows[31].assignable is False
    assert rows[10].title == "Music" and rows[10].assignable is True
    assert sorted(rows)[:4] == [1, 2, 10, 15]


def test_multiline_csv(spark, workdir):
    import os

    path = os.path.join(workdir, "multiline.csv")
    from tests.fixtures import GOLDEN_CSV

    header, first = GOLDEN_CSV.splitlines()[:2]
    row = first.replace(",desc", ',"two\nlines"')
    with open(path, "w") as f:
        f.write(header + "\n" + row + "\n")
    df = read_trending(spark, path, multi_line=True)
    assert df.count() == 1
    assert df.first().description == "two\nlines"
    assert df.where(~F.col("_malformed")).count() == 1
