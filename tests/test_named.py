"""Files with names of their own: exact names, all or nothing."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from trendstats.sinks import category_files, write_named
from trendstats.sources import category_items, read_categories


def lines_of(folder):
    found = {}
    for name in sorted(os.listdir(folder)):
        if os.path.isfile(os.path.join(folder, name)) and not name.startswith((".", "_")):
            with open(os.path.join(folder, name)) as f:
                found[name] = f.read().splitlines()
    return found


def ranked(spark, n=60):
    return spark.range(n).select(F.concat(F.lit("c"), (F.col("id") % 3).cast("string"), F.lit(".csv")).alias("f"), "id")


def write(df, folder, **options):
    write_named(df, str(folder), F.col("f"), F.col("id").cast("string"), ["id"], **options)


def test_exact_names_in_order_with_a_header(spark, tmp_path):
    write(ranked(spark), tmp_path, header="n", partitions=1)
    want = {f"c{k}.csv": ["n", *[str(i) for i in range(60) if i % 3 == k]] for k in range(3)}
    assert lines_of(tmp_path) == want
    assert sorted(os.listdir(tmp_path)) == ["_SUCCESS", "_staging", *want]
    assert os.listdir(tmp_path / "_staging") == []


def test_a_large_file_comes_in_numbered_pieces(spark, tmp_path):
    write(ranked(spark, 600), tmp_path, partitions=7)
    found = lines_of(tmp_path)
    pieces = sorted((n for n in found if n.startswith("c0.")), key=lambda n: int((n.split(".")[1:-1] or ["1"])[0]))
    assert pieces[:2] == ["c0.csv", "c0.2.csv"]
    assert [int(x) for n in pieces for x in found[n]] == list(range(0, 600, 3))


def test_overwrite_replaces_and_append_adds(spark, tmp_path):
    write(ranked(spark), tmp_path, partitions=1)
    write(ranked(spark).where("f = 'c1.csv'"), tmp_path, partitions=1)
    assert list(lines_of(tmp_path)) == ["c1.csv"]
    write(ranked(spark).where("f = 'c2.csv'"), tmp_path, partitions=1, mode="append")
    assert list(lines_of(tmp_path)) == ["c1.csv", "c2.csv"]


def test_a_failed_task_leaves_nothing(spark, tmp_path):
    write(ranked(spark), tmp_path, partitions=1)
    before = lines_of(tmp_path)
    broken = ranked(spark).withColumn("id", F.when(F.col("id") == 50, F.raise_error(F.lit("broken"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="broken"):
        write(broken.repartition(4), tmp_path, partitions=3)
    with pytest.raises(Exception, match="not a file name"):
        write(ranked(spark).withColumn("f", F.lit("../x")), tmp_path)
    assert lines_of(tmp_path) == before
    assert os.listdir(tmp_path / "_staging") == []


def test_a_null_line_makes_an_empty_file(spark, tmp_path):
    df = spark.createDataFrame([("a.csv", None)], "f string, id long")
    write(df, tmp_path, header="h")
    assert lines_of(tmp_path) == {"a.csv": ["h"]}


def test_category_names(spark, cats):
    names = {r.category_id: r.file for r in category_files(cats).collect()}
    assert names[10] == "Music.csv" and names[31] == "Anime_Animation.csv"
    assert names[23] == "Comedy (23).csv" and names[34] == "Comedy (34).csv"


def test_items_of_a_document_are_rejected_one_by_one(spark, tmp_path):
    good = {"kind": "k", "items": [{"id": "1", "snippet": {"title": "Film", "assignable": True}}, {"id": 2, "snippet": {"title": "Two"}}]}
    bad = {"items": [{"id": "x", "snippet": {"title": "A"}}, {"id": "3"}, {"id": "4", "snippet": {"title": 5}}, 7, {"id": "6", "snippet": {"title": "Six", "assignable": False}}]}
    for name, text in (("a", json.dumps(good, indent=1)), ("b", json.dumps(bad)), ("c", "{nothing"), ("d", '{"items": 3}'), ("e", '{"items": []}')):
        (tmp_path / f"{name}.json").write_text(text)
    rows = {(r.file[0], r.position): tuple(r)[2:] for r in category_items(spark, str(tmp_path)).collect()}
    assert rows == {
        ("a", 0): (1, "Film", True, None), ("a", 1): (2, "Two", None, None),
        ("b", 0): (None, "A", None, "id"), ("b", 1): (3, None, None, "title"), ("b", 2): (4, None, None, "title"),
        ("b", 3): (None, None, None, "id"), ("b", 4): (6, "Six", False, None),
        ("c", None): (None, None, None, "document"), ("d", None): (None, None, None, "items"),
    }


def test_items_agree_with_the_typed_reader(spark, categories_json):
    items = category_items(spark, categories_json).where("reason is null").select("category_id", "title", "assignable")
    assert sorted(map(tuple, items.collect())) == sorted(map(tuple, read_categories(spark, categories_json).collect()))


def test_menu_entries_as_named_files_from_a_stored_rollup(spark, golden_csv, categories_json, tmp_path):
    from trendstats.__main__ import main

    state, out, folders = str(tmp_path / "state"), str(tmp_path / "out"), str(tmp_path / "folders")
    for _ in range(2):  # the second merge changes nothing
        main(["merge-batch", "day", golden_csv, state, "--buckets", "4"], stop=False)
    main(["menu", "3", state, categories_json, "--state", "--named", "--ids", "10,31,44", "--out", out], stop=False)
    main(["menu", "7", state, categories_json, "--state", "--named", "--k", "3", "--out", out], stop=False)
    main(["menu", "3", golden_csv, categories_json, "--ids", "10,31,44", "--out", folders], stop=False)
    files = lines_of(f"{out}/filter_videos")
    assert sorted(files) == ["Anime_Animation.csv", "Music.csv", "Trailers.csv"]
    assert len(files["Trailers.csv"]) == 1  # the header only
    want = spark.read.text(f"{folders}/filter_videos/category_id=10").collect()
    assert files["Music.csv"] == [r.value for r in want]
    assert lines_of(out)["top3views.csv"][0] == files["Trailers.csv"][0] and len(lines_of(out)["top3views.csv"]) == 4


def test_route_command(golden_csv, tmp_path, capsys):
    from trendstats.__main__ import main

    main(["route", golden_csv, str(tmp_path / "r")], stop=False)
    counts = dict(line.split(": ") for line in capsys.readouterr().out.splitlines() if ": " in line)
    assert int(counts["n_read"]) == int(counts["n_accepted"]) + sum(int(v) for k, v in counts.items() if not k.startswith("n_"))
