"""The video-grain menu: each entry is one lazy DataFrame over the rollup.

The original tool asked for a category selection first (``0`` = all) and
then ran one Spark job per chosen category, collecting rows to the driver
in between. Here a selection is a list of ids (``None`` = every id of the
dimension; ids missing from it are refused) and each entry is a single plan: one filter for all chosen
categories, one grouped top-k or one global top-k.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendstats import operators as op
from trendstats.operators import incremental
from trendstats.schema import TRENDING_DATE_FORMAT, VIDEO_COLUMNS, VIDEO_CSV_HEADER
from trendstats.sinks import category_files, video_csv_frame, write_by_category, write_named, write_ranked
from trendstats.sources import read_categories, read_trending

# Menu number → (entry name, metric, per category?, year filter?).
MENU = {
    2: ("count_videos", None, None, False),
    3: ("filter_videos", "views", True, False),
    4: ("topk_likes_per_category", "likes", True, False),
    5: ("topk_dislikes_per_category", "dislikes", True, False),
    6: ("topk_views_per_category", "views", True, False),
    7: ("topk_views", "views", False, False),
    8: ("topk_likes", "likes", False, False),
    9: ("topk_dislikes", "dislikes", False, False),
    10: ("topk_views_of_year", "views", False, True),
    11: ("topk_likes_of_year", "likes", False, True),
    12: ("topk_dislikes_of_year", "dislikes", False, True),
}


def normalise_selection(ids: Sequence[int] | None) -> list[int] | None:
    """``None``, ``[]`` or ``[0]`` select every category."""
    if ids is None or len(ids) == 0 or list(ids) == [0]:
        return None
    return list(dict.fromkeys(int(i) for i in ids))


def menu_query(
    spark: SparkSession,
    choice: int,
    videos: DataFrame,
    cats: DataFrame,
    ids: Sequence[int] | None,
    k: int | None = None,
    year: int = 2018,
) -> DataFrame:
    """The DataFrame of menu entry ``choice`` (2-12)."""
    if choice not in MENU:
        raise ValueError(f"menu entry must be one of {sorted(MENU)}, got {choice}")
    name, metric, per_category, by_year = MENU[choice]
    sel = normalise_selection(ids)
    chosen = op.in_categories(videos, sel, cats)
    columns = [c for c in (*VIDEO_COLUMNS, "trending_date_text") if c in videos.columns or c == "category"]
    if name == "count_videos":
        return op.count_videos_by_category(spark, videos, cats, sel)
    if name == "filter_videos":
        return op.filter_videos_by_category(op.titled(chosen, cats, columns), None)
    if k is None:
        raise ValueError("this menu entry needs k")
    if per_category:
        top = op.topk_videos_by_category(chosen, metric, k)
    else:
        top = op.topk_videos(chosen, metric, k, year=year if by_year else None)
    # the category title is looked up for the output rows only
    return op.titled(top, cats, [*columns, "rank"])


def output_name(choice: int, k: int | None, year: int = 2018) -> str:
    """File name of an overall top-k result, e.g. ``top10views``,
    ``top10likesOf2018``; the entry name for the others."""
    name, metric, per_category, by_year = MENU[choice]
    if per_category is False:
        return f"top{k}{metric}" + (f"Of{year}" if by_year else "")
    return name


def write_named_entry(
    result: DataFrame, cats: DataFrame, out_dir: str, choice: int, ids: Sequence[int] | None, k: int | None, year: int
) -> None:
    """A menu entry's rows as CSV files of exact names; a chosen category
    without rows gets a file with the header only."""
    frame = video_csv_frame(result)
    line = F.to_csv(F.struct(*[F.col(f"`{c}`") for c in VIDEO_CSV_HEADER]))
    header, root = ",".join(VIDEO_CSV_HEADER), out_dir.rstrip("/")
    if MENU[choice][2]:
        files = category_files(cats)
        if (selected := normalise_selection(ids)) is not None:
            files = files.where(F.col("category_id").isin(selected))
        rows = files.join(frame, "category_id", "left")
        keys = [F.col("rank")] if "rank" in frame.columns else [-F.col("views"), F.col("video_id")]
        line = F.when(F.col("URL").isNotNull(), line)
        write_named(rows, f"{root}/{output_name(choice, k, year)}", F.col("file"), line, keys, header)
    else:
        write_named(frame, root, F.lit(f"{output_name(choice, k, year)}.csv"), line, ["rank"], header, mode="append", partitions=1)


def run_menu(
    spark: SparkSession,
    choice: int,
    trending_path: str,
    categories_path: str,
    ids: Sequence[int] | None,
    out_dir: str | None = None,
    k: int | None = None,
    year: int = 2018,
    mode: str = "csv",
    trending_date_format: str = TRENDING_DATE_FORMAT,
    state: bool = False,
    named: bool = False,
) -> DataFrame:
    """Read, roll up, answer one menu entry and (with ``out_dir``) write it:
    per-category entries as ``<out>/<entry>/category_id=<id>/``, overall
    top-k lists as one CSV in ``<out>/top<k><metric>[Of<year>]``.

    ``state``: the path is a stored rollup (``operators.incremental``).
    ``named``: entries 3-12 become files of exact names, ``<category>.csv`` in
    ``<out>/<entry>/`` or ``<out>/top<k><metric>[Of<year>].csv``, as one commit."""
    cats = read_categories(spark, categories_path)
    if state:
        videos = incremental.read_videos(spark, trending_path)
    else:
        videos = op.rollup_videos(read_trending(spark, trending_path, mode=mode, trending_date_format=trending_date_format))
    result = menu_query(spark, choice, videos, cats, ids, k, year)
    if out_dir and named and MENU[choice][2] is not None:
        write_named_entry(result, cats, out_dir, choice, ids, k, year)
    elif out_dir:
        target = f"{out_dir.rstrip('/')}/{output_name(choice, k, year)}"
        name, _, per_category, _ = MENU[choice]
        if per_category:
            known = cats.where(F.col("category_id").isin(selected)) if (selected := normalise_selection(ids)) else cats
            # the header-only files of empty categories: one a chosen category
            write_by_category(result, target, chosen=[r["category_id"] for r in known.select("category_id").toLocalIterator()])
        elif per_category is False:
            write_ranked(result, target)
        else:
            result.write.option("header", True).option("escape", '"').mode("overwrite").csv(target)
    return result
