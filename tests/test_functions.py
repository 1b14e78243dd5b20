"""Column functions and the job helpers built on them."""

from __future__ import annotations

import glob
import os

from pyspark.sql import functions as F

from trendstats import functions as fn
from trendstats import operators as op
from trendstats.plans import jobs


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first().x


def test_label_round_trip(spark):
    assert one(spark, fn.category_label(F.lit(31), F.lit("Anime/Animation"))) == "31:Anime/Animation"
    assert one(spark, fn.category_label(F.lit(99), F.lit(None).cast("string"))) == "99:null"
    assert one(spark, fn.category_id_of_label(F.lit(" 24 :Entertainment"))) == 24
    assert one(spark, fn.category_id_of_label(F.lit("x:y"))) is None


def test_lines(spark):
    assert one(spark, fn.prefixed_line(F.lit("Music"), F.lit("a,b"))) == "Music: a,b"
    assert one(spark, fn.single_line(F.lit("a\r\nb\nc"))) == "a b c"
    assert one(spark, fn.ranked_line(F.lit(3), F.lit("x"))) == "3: x"
    assert one(spark, fn.us_date(F.lit("2018-01-05").cast("date"))) == "01/05/2018"
    assert one(spark, fn.watch_url(F.lit("abc"))) == "https://www.youtube.com/watch?v=abc"


def test_display_ready(records):
    got = sorted(r.video_id for r in op.display_ready(records).select("video_id").collect())
    assert "v08" not in got and "v11" not in got and "v14" not in got
    assert got.count("v07") == 1  # the record with bad views is not shown


def test_views_sort_job(spark, golden_csv, categories_json, workdir):
    out = os.path.join(workdir, "views_sort")
    summary = jobs.views_sort(spark, golden_csv, out, categories_json).first()
    lines = []
    for f in sorted(glob.glob(os.path.join(out, "part-*"))):
        lines += open(f).read().splitlines()
    # the whole record: 16 fields, the date and the flags as they were read
    assert lines[0] == (
        'Entertainment: v04,18.01.02,Chan comma,"B, Inc",24,2018-02-28T00:00:00.000Z,x,50,5,0,5,http://t/4,False,False,False,desc'
    )
    assert lines[-1].startswith("Music: v06,18.02.02,Big,")
    assert len(lines) == summary.n_output == 11


def test_topk_job_counts_with_total(spark, golden_csv, workdir):
    counts = jobs.topk_records(spark, "likes", 1, golden_csv, os.path.join(workdir, "topk_likes"))
    got = {(r.category_id, r.is_total): r.n_records for r in counts.collect()}
    assert got == {(10, 0): 6, (24, 0): 2, (25, 0): 1, (27, 0): 1, (28, 0): 0, (None, 1): 10}
