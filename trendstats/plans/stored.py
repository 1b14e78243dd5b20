"""Registered queries that write with the library's sinks and stored layouts
and read back what a user would find there.

Each writes to a folder under the shared checkpoint folder, reads it, cuts the
result to the checkpoint folder and removes what it wrote.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendstats import operators as op
from trendstats import sinks
from trendstats.functions.columns import category_id_of_label, category_label
from trendstats.operators import incremental
from trendstats.operators.rank import RECORD_TIEBREAK
from trendstats.plans import catalog as C
from trendstats.plans import jobs
from trendstats.schema import METRICS, VIDEO_COLUMNS, VIDEO_CSV_HEADER
from trendstats.session import ensure_checkpoint_dir, remove, scratch
from trendstats.sources import category_items, read_trending, valid_records
from trendstats.sources.tables import _table

BATCHES = 3  # the rollup state takes the trending years modulo this
BUCKETS = 8  # of the bucketed rollup: at least
SCALE = 10**13  # metrics times this overflow a 64-bit total
PAGE = (101, 150)  # ranks of the page query
BAD_ID, BAD_TITLE = (7, 5), (11, 7)  # (modulus, remainder) of nation keys whose item is broken


def _in_folder(spark: SparkSession, use: Callable[[str], DataFrame]) -> DataFrame:
    folder = scratch(spark, "stored")
    ensure_checkpoint_dir(spark)
    result = use(folder).checkpoint(eager=True)
    remove(spark, folder)
    return result


def _numbered_lines(text: DataFrame, *keep: Column | str) -> DataFrame:
    """Whole files as ``(line_no, line)``."""
    lines = text.select(*keep, F.posexplode(F.split("value", "\n")).alias("line_no", "line"))
    return lines.where("line != ''")


# --- the rollup, stored ------------------------------------------------------


def rollup_videos_incremental(spark, sf_dir):
    """The rollup merged from three batches; the first is replayed."""
    records = C._records(spark, sf_dir)
    batch = F.coalesce(F.year("trending_date") % BATCHES, F.lit(0))

    def use(folder):
        for b in (*range(BATCHES), 0):
            incremental.merge_batch(spark, folder, records.where(batch == b), f"batch {b}", buckets=BUCKETS)
        return op.titled(incremental.read_videos(spark, folder), C._cats(spark, sf_dir), VIDEO_COLUMNS)

    return _in_folder(spark, use)


def rollup_videos_bucketed(spark, sf_dir):
    """The rollup over a table bucketed by video (no exchange)."""
    name = "records_" + uuid.uuid4().hex

    def use(folder):
        records = C._records(spark, sf_dir)
        stored = sinks.write_bucketed_table(records, name, sinks.bucket_count(records, BUCKETS), folder)
        return op.titled(op.rollup_videos(stored), C._cats(spark, sf_dir), VIDEO_COLUMNS)

    result = _in_folder(spark, use)
    spark.sql(f"DROP TABLE {name}")
    return result


def sum_views_wide(spark, sf_dir):
    """Totals past 64 bits, as text."""
    records = C._records(spark, sf_dir).withColumn("views", F.col("views") * F.lit(SCALE))
    sums = op.sum_views_by_category(records, C._cats(spark, sf_dir), C.FOCUS, wide=True)
    return sums.select("category_id", "category", F.col("views").cast("string").alias("views"))


def records_last_month_dated(spark, sf_dir):
    """The month's list read from a table clustered by publish date."""

    def use(folder):
        sinks.write_dated_table(valid_records(C._records(spark, sf_dir)), folder)
        return op.records_in_range(spark.read.parquet(folder), C.FOCUS, "last-month", C.AS_OF)

    return _in_folder(spark, use)


def records_page(spark, sf_dir):
    """A page of one category's records by views."""

    def use(folder):
        records = op.in_categories(valid_records(C._records(spark, sf_dir)), C.FOCUS)
        order = [F.desc("views"), *[F.asc(c) for c in RECORD_TIEBREAK if c != "views"]]
        columns = ["category_id", *RECORD_TIEBREAK]
        sinks.write_ranked_list(records.select(columns), folder, ["category_id"], order)
        return sinks.read_ranks(spark, folder, {"category_id": C.SINGLE_CATEGORY}, *PAGE)

    return _in_folder(spark, use)


def dirty_routed(spark, sf_dir):
    """Accepted and rejected rows of the dirty lines, written in one pass."""

    def use(folder):
        C.dirty_lines(spark, sf_dir).write.text(f"{folder}/in")
        records = read_trending(spark, f"{folder}/in", trending_date_format="yyyy-MM-dd")
        sinks.write_routed(records, f"{folder}/out", METRICS, display=True)
        accepted = sinks.read_routed(spark, f"{folder}/out", "accepted").select(F.lit("accepted").alias("route"), F.lit(None).cast("string").alias("reason"))
        rejected = sinks.read_routed(spark, f"{folder}/out", "rejected").select(F.lit("rejected").alias("route"), "reason")
        return accepted.union(rejected).groupBy("route", "reason").agg(F.count(F.lit(1)).alias("n_records"))

    return _in_folder(spark, use)


# --- categories --------------------------------------------------------------


def write_category_documents(spark: SparkSession, sf_dir: str, path: str) -> None:
    """A category document per region of the nation table; some items have no
    number as id, some no title."""
    key = F.col("n_nationkey")
    bad = lambda rule: key % rule[0] == rule[1]
    item = F.struct(
        F.lit("category").alias("kind"),
        F.when(bad(BAD_ID), F.lit("n/a")).otherwise(key.cast("string")).alias("id"),
        F.struct(F.when(~bad(BAD_TITLE), F.col("n_name")).alias("title"), (key % 2 == 0).alias("assignable")).alias("snippet"),
    )
    docs = _table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.collect_list(item).alias("items"))
    text = F.to_json(F.struct(F.lit("category list").alias("kind"), "items")).alias("value")
    docs.select("n_regionkey", text).repartition("n_regionkey").write.partitionBy("n_regionkey").text(path)


def category_document_items(spark, sf_dir):
    def use(folder):
        write_category_documents(spark, sf_dir, folder)
        return category_items(spark, f"{folder}/*/").select("category_id", "title", "assignable", "reason")

    return _in_folder(spark, use)


def category_labels(spark, sf_dir):
    """Labels of all categories and the ids read back from them."""
    label = category_label("category_id", "title")
    return C._cats(spark, sf_dir).select(label.alias("label"), category_id_of_label(label).alias("category_id"))


# --- files -------------------------------------------------------------------


def _chosen_videos(spark, sf_dir):
    return op.titled(op.in_categories(C._untitled_videos(spark, sf_dir), C.FOCUS), C._cats(spark, sf_dir), VIDEO_COLUMNS)


def video_csv_by_category(spark, sf_dir):
    """Lines of the CSV folders per category, without the header lines."""

    def use(folder):
        sinks.write_by_category(_chosen_videos(spark, sf_dir), folder, chosen=C.FOCUS)
        return spark.read.text(folder).where(F.col("value") != ",".join(VIDEO_CSV_HEADER)).select("category_id", F.col("value").alias("line"))

    return _in_folder(spark, use)


def ranked_csv_file(spark, sf_dir):
    """The one CSV file of an overall top-k, line by line."""

    def use(folder):
        top = op.topk_videos(C._untitled_videos(spark, sf_dir), "views", C.K_OVERALL, C.FOCUS)
        sinks.write_ranked(op.titled(top, C._cats(spark, sf_dir), [*VIDEO_COLUMNS, "rank"]), folder)
        return _numbered_lines(spark.read.text(folder, wholetext=True))

    return _in_folder(spark, use)


def named_category_files(spark, sf_dir):
    """Files named after their categories, line by line."""
    cats = C._cats(spark, sf_dir)

    def use(folder):
        top = op.topk_videos_by_category(C._untitled_videos(spark, sf_dir), "likes", C.K_PER_CATEGORY, C.FOCUS)
        frame = sinks.video_csv_frame(op.titled(top, cats, [*VIDEO_COLUMNS, "rank"]))
        line = F.to_csv(F.struct(*[F.col(f"`{c}`") for c in VIDEO_CSV_HEADER]))
        named = frame.join(sinks.category_files(cats), "category_id")
        sinks.write_named(named, folder, F.col("file"), line, ["rank"], header=",".join(VIDEO_CSV_HEADER), partitions=1)
        return _numbered_lines(spark.read.text(f"{folder}/*.csv", wholetext=True), F.col("_metadata.file_name").alias("file"))

    return _in_folder(spark, use)


def _text_by_category(rows):
    def q(spark, sf_dir):
        def use(folder):
            sinks.write_text_by_category(rows(spark, sf_dir), folder)
            return spark.read.text(folder).select("category_id", F.col("value").alias("line"))

        return _in_folder(spark, use)

    return q


def _text(fmt, rows):
    def q(spark, sf_dir):
        def use(folder):
            sinks.write_table(rows(spark, sf_dir), folder, fmt)
            return spark.read.text(folder).select(F.col("value").alias("line"))

        return _in_folder(spark, use)

    return q


def views_sort_text(spark, sf_dir):
    """The whole job: CSV files and category documents in, lines out."""

    def use(folder):
        sinks.write_snapshot_csv(C._records(spark, sf_dir), f"{folder}/csv")
        write_category_documents(spark, sf_dir, f"{folder}/cats")
        jobs.views_sort(spark, f"{folder}/csv", f"{folder}/out", f"{folder}/cats/*/", C.FOCUS, trending_date_format="yyyy-MM-dd")
        return spark.read.text(f"{folder}/out").select(F.col("value").alias("line"))

    return _in_folder(spark, use)


QUERIES: dict[str, C.Query] = {
    "rollup_videos_incremental": rollup_videos_incremental,
    "rollup_videos_bucketed": rollup_videos_bucketed,
    "sum_views_by_category_wide": sum_views_wide,
    "records_last_month_dated": records_last_month_dated,
    "records_page": records_page,
    "dirty_routed": dirty_routed,
    "category_document_items": category_document_items,
    "category_labels": category_labels,
    "video_csv_by_category": video_csv_by_category,
    "ranked_csv_file": ranked_csv_file,
    "named_category_files": named_category_files,
    "ranked_text_by_category": _text_by_category(
        lambda spark, sf_dir: op.topk_records_by_category(C._records(spark, sf_dir), "likes", C.K_PER_CATEGORY, C.FOCUS)
    ),
    "dated_text_by_category": _text_by_category(
        lambda spark, sf_dir: op.records_in_range(C._records(spark, sf_dir), C.FOCUS, "last-6-Months", C.AS_OF)
    ),
    "tuple_text": _text(
        "tuple",
        lambda spark, sf_dir: op.sum_likes_dislikes_by_category(C._records(spark, sf_dir), C._cats(spark, sf_dir), C.FOCUS).select(
            "category", "likes", "dislikes"
        ),
    ),
    "display_text": _text(
        "text", lambda spark, sf_dir: op.filter_records_by_category(C._records(spark, sf_dir), C.SINGLE_CATEGORY).select("line")
    ),
    "views_sort_text": views_sort_text,
}
