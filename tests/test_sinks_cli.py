"""Writers and the command line on the golden inputs."""

from __future__ import annotations

import csv
import glob
import os

from trendstats import operators as op
from trendstats.sinks import write_by_category, write_ranked, write_table, write_text_by_category


def read_lines(folder):
    out = []
    for f in sorted(glob.glob(os.path.join(folder, "part-*"))):
        with open(f) as fh:
            out += fh.read().splitlines()
    return out


def test_by_category_uses_ids(spark, records, cats, workdir):
    videos = op.rollup_videos(records, cats)
    target = os.path.join(workdir, "by_category")
    write_by_category(op.in_categories(videos, [23, 31, 10]), target)
    dirs = sorted(os.path.basename(d) for d in glob.glob(os.path.join(target, "category_id=*")))
    assert dirs == ["category_id=10", "category_id=23", "category_id=31"]
    lines = read_lines(os.path.join(target, "category_id=31"))
    assert lines[0] == "title,category_id:category,publish_date,trending_date,channel_title,views,likes,dislikes,URL"
    assert lines[1].startswith("Slash,31:Anime/Animation,2018-01-08,")
    music = [line for line in read_lines(os.path.join(target, "category_id=10")) if not line.startswith("title,")]
    assert [row[0] for row in csv.reader(music)] == ["Big", "Comma, twice", "Plain"]  # views descending


def test_ranked_csv_one_file(spark, records, cats, workdir):
    videos = op.rollup_videos(records, cats)
    target = os.path.join(workdir, "top3views")
    write_ranked(op.topk_videos(videos, "views", 3), target)
    files = glob.glob(os.path.join(target, "part-*.csv"))
    assert len(files) == 1
    lines = read_lines(target)
    assert lines[0].startswith("title,category_id:category")
    assert [row[0] for row in csv.reader(lines[1:])] == ["Big", "Comma, twice", "Plain"]
    assert lines[1].endswith(",https://www.youtube.com/watch?v=v06")


def test_ranked_text(spark, records, workdir):
    top = op.topk_records_by_category(records, "views", 2, [10, 24])
    target = os.path.join(workdir, "topk_text")
    write_text_by_category(top, target)
    ent = read_lines(os.path.join(target, "category_id=24"))
    assert ent == [
        "1: title: Comma, once (v03)\tdate: 12/31/2017\tviews: 999\tlikes: 7\tcategory: 24",
        "2: title: Chan comma (v04)\tdate: 02/28/2018\tviews: 50\tlikes: 5\tcategory: 24",
    ]


def test_tuple_text(spark, records, cats, workdir):
    target = os.path.join(workdir, "tuples")
    write_table(op.sum_views_by_category(records, cats, [24]).select("category", "views"), target, "tuple")
    assert read_lines(target) == ["(Entertainment,1049)"]


def test_cli_menu_and_jobs(golden_csv, categories_json, workdir, capsys):
    from trendstats.__main__ import main

    out = os.path.join(workdir, "cli")
    assert main(["menu", "7", golden_csv, categories_json, "--ids", "0", "--k", "2", "--out", out], stop=False) == 0
    assert [row[0] for row in csv.reader(read_lines(os.path.join(out, "top2views"))[1:])] == ["Big", "Comma, twice"]
    assert main(["views-count", golden_csv, os.path.join(workdir, "vc"), "--categories", categories_json], stop=False) == 0
    assert sorted(read_lines(os.path.join(workdir, "vc"))) == [
        "(Education,70)", "(Entertainment,1049)", "(Music,4002001001)", "(News & Politics,60)",
        "(Science & Technology,80)"]
    assert main(["date-range", "last-month", golden_csv, os.path.join(workdir, "dr"), "--as-of", "2018-03-31"], stop=False) == 0
    assert read_lines(os.path.join(workdir, "dr", "category_id=25")) == [
        "1: 2018-03-01 - https://www.youtube.com/watch?v=v05 - title:No description"]
    assert main(["filter-by-category", "24", golden_csv, os.path.join(workdir, "fc")], stop=False) == 0
    assert len(read_lines(os.path.join(workdir, "fc"))) == 2


def test_cli_menu_entries(golden_csv, categories_json, workdir, capsys):
    from trendstats.__main__ import main

    out = os.path.join(workdir, "cli_menu")
    assert main(["menu", "2", golden_csv, categories_json, "--ids", "23,34"], stop=False) == 0
    shown = capsys.readouterr().out
    assert "|23         |Comedy  |1       |" in shown and "|34         |Comedy  |0       |" in shown
    assert main(["menu", "3", golden_csv, categories_json, "--ids", "10", "--out", out], stop=False) == 0
    rows = list(csv.reader(read_lines(os.path.join(out, "filter_videos", "category_id=10"))))
    assert [r[0] for r in rows if r[0] != "title"] == ["Big", "Comma, twice", "Plain"]
    assert main(["menu", "4", golden_csv, categories_json, "--ids", "24", "--k", "1", "--out", out], stop=False) == 0
    rows = list(csv.reader(read_lines(os.path.join(out, "topk_likes_per_category", "category_id=24"))))
    assert [r[0] for r in rows if r[0] != "title"] == ["Comma, once"]
    assert main(["menu", "10", golden_csv, categories_json, "--k", "2", "--year", "2018", "--out", out], stop=False) == 0
    rows = list(csv.reader(read_lines(os.path.join(out, "top2viewsOf2018"))))
    assert [r[0] for r in rows[1:]] == ["Big", "Comma, twice"]
    assert main(["categories", categories_json, "--ids", "24,99"], stop=False) == 0
    shown = capsys.readouterr().out
    assert "Entertainment" in shown and "|99         |" in shown


def test_snapshot_csv_round_trip(spark, records, workdir):
    from trendstats.sinks import write_snapshot_csv
    from trendstats.sources import read_trending, valid_records
    from trendstats.schema import RECORD_COLUMNS

    good = valid_records(records, need_date=True).select(*RECORD_COLUMNS)
    target = os.path.join(workdir, "snapshot_round_trip")
    write_snapshot_csv(good, target)
    for mode in ("csv", "line"):
        back = read_trending(spark, target, mode=mode, trending_date_format="yyyy-MM-dd")
        assert back.where("_malformed").count() == 0
        a = sorted(tuple(r) for r in back.select(*RECORD_COLUMNS).collect())
        b = sorted(tuple(r) for r in good.collect())
        assert a == b, mode


def test_quoted_fields_survive_csv_sink(spark, records, workdir):
    target = os.path.join(workdir, "quoted")
    write_table(records.where("video_id = 'v03'").select("video_id", "description"), target, "csv")
    back = spark.read.option("header", True).option("escape", '"').csv(target).first()
    assert back.description == 'a "quoted" desc, with comma'


def test_cli_explain(golden_csv, categories_json, capsys):
    from trendstats.__main__ import main

    assert main(["--explain", "menu", "7", golden_csv, categories_json, "--ids", "10,24", "--k", "3"], stop=False) == 0
    plan = capsys.readouterr().out
    assert "TakeOrderedAndProject" in plan and "== Physical Plan ==" in plan


def test_cli_job_ids(golden_csv, categories_json, workdir):
    from trendstats.__main__ import main

    out = os.path.join(workdir, "vc_ids")
    assert main(["views-count", golden_csv, out, "--categories", categories_json, "--ids", "24,31"], stop=False) == 0
    assert sorted(read_lines(out)) == ["(Anime/Animation,91)", "(Entertainment,1049)"]


def test_iso_dates_reach_the_video_csv(golden_csv, categories_json, workdir):
    """The trending date is written as it was read, whatever its format."""
    from trendstats.__main__ import main

    iso = os.path.join(workdir, "iso_input", "iso.csv")
    os.makedirs(os.path.dirname(iso))
    with open(golden_csv) as f, open(iso, "w") as g:
        g.write(f.read().replace("18.01.02", "2018-02-01").replace("18.02.02", "2018-02-02"))
    for extra, name in (([], "iso_default"), (["--date-format", "yyyy-MM-dd"], "iso_named")):
        out = os.path.join(workdir, name)
        assert main([*extra, "menu", "7", iso, categories_json, "--ids", "0", "--k", "3", "--out", out], stop=False) == 0
        rows = list(csv.DictReader(read_lines(os.path.join(out, "top3views"))))
        assert [r["trending_date"] for r in rows] == ["2018-02-01"] * 3


def test_empty_category_gets_a_header_and_unknown_is_refused(golden_csv, categories_json, workdir):
    from trendstats.__main__ import main

    out = os.path.join(workdir, "empty_category")
    assert main(["menu", "3", golden_csv, categories_json, "--ids", "10,17,99", "--out", out], stop=False) == 0
    folder = os.path.join(out, "filter_videos")
    assert sorted(d for d in os.listdir(folder) if d.startswith("category_id")) == ["category_id=10", "category_id=17"]
    assert read_lines(os.path.join(folder, "category_id=17")) == [
        "title,category_id:category,publish_date,trending_date,channel_title,views,likes,dislikes,URL"]


def test_unknown_ids_are_refused_in_every_entry(spark, records, cats):
    from trendstats.plans.menu import MENU, menu_query

    videos = op.rollup_videos(records)
    for choice in MENU:
        got = menu_query(spark, choice, videos, cats, [10, 99], k=50)
        assert {r.category_id for r in got.collect()} == {10}, choice


def test_cli_shows_every_row(golden_csv, categories_json, workdir, capsys):
    from tests.fixtures import CATEGORY_ROWS
    from trendstats.__main__ import main

    ids = ",".join(str(c) for c, _, _ in CATEGORY_ROWS)
    out = os.path.join(workdir, "many")
    assert main(["menu", "2", golden_csv, categories_json, "--ids", ids], stop=False) == 0
    shown = capsys.readouterr().out
    assert all(f"|{c} " in shown for c, _, _ in CATEGORY_ROWS)
    assert main(["date-range", "no-date-filter", golden_csv, out, "--ids", ids], stop=False) == 0
    shown = capsys.readouterr().out
    assert "only showing" not in shown and "|NULL" in shown  # the total
    assert main(["menu", "7", golden_csv, categories_json, "--k", "1500"], stop=False) == 2  # needs --out


def test_job_summary_comes_from_one_pass(spark, golden_csv, workdir):
    from trendstats.plans import jobs
    from trendstats.sources import read_trending

    ids = [10, 24, 25, 27, 28]
    got = jobs.views_count(spark, golden_csv, os.path.join(workdir, "observed"), ids=ids).first().asDict()
    assert got == op.run_summary(read_trending(spark, golden_csv), ids, ("views",)).first().asDict()
