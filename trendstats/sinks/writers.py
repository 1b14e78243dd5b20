"""Writers for query results.

All writes are distributed (each task writes its own files); nothing is
collected to the driver. Directory names come from category *ids*, so two
categories with the same title never overwrite each other and titles with
``/`` are harmless.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from trendstats.functions.columns import category_label, ranked_line, single_line
from trendstats.schema import VIDEO_CSV_HEADER
from trendstats.session import exists


def video_csv_frame(videos: DataFrame) -> DataFrame:
    """The nine CSV output fields of a video row (``category_id:category``
    joined as one label, the trending date as the source wrote it), keeping
    ``category_id`` for partitioning and ``video_id`` for the order."""
    day = F.col("trending_date").cast("string")
    if "trending_date_text" in videos.columns:
        day = F.coalesce("trending_date_text", day)
    values = {
        "category_id:category": category_label("category_id", "category"),
        "publish_date": F.col("publish_date").cast("string"),
        "trending_date": day,
        "URL": F.col("url"),
    }
    cols = [values.get(c, F.col(c)).alias(c) for c in VIDEO_CSV_HEADER]
    return videos.select(*cols, "category_id", "video_id", *[c for c in ("rank",) if c in videos.columns])


def write_by_category(
    videos: DataFrame, path: str, mode: str = "overwrite", chosen: Sequence[int] | None = None
) -> None:
    """One CSV directory per category id (``category_id=<id>/``), header
    line included, rows in rank order when there is a rank, else by views.
    A ``chosen`` category without rows gets a file with the header only."""
    frame = video_csv_frame(videos)
    order = ["category_id", "rank"] if "rank" in frame.columns else ["category_id", F.desc("views"), "video_id"]
    # No explicit count: AQE sizes the range partitions (small results end
    # up in one file per category, large ones are split).
    (
        frame.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .drop("rank", "video_id")
        .write.partitionBy("category_id")
        .option("header", True)
        .option("escape", '"')
        .mode(mode)
        .csv(path)
    )
    spark = videos.sparkSession
    fields = [f for f in frame.schema.fields if f.name in VIDEO_CSV_HEADER]
    for i in chosen or ():
        folder = f"{path.rstrip('/')}/category_id={int(i)}"
        if not exists(spark, folder):
            spark.createDataFrame([], StructType(fields)).coalesce(1).write.option("header", True).csv(folder)


def write_ranked(df: DataFrame, path: str, mode: str = "overwrite", rank_col: str = "rank") -> None:
    """A top-k result as one CSV file with a header, in rank order. One task
    writes it: meant for k up to a few million rows."""
    frame = video_csv_frame(df) if "url" in df.columns else df
    frame = frame.drop("category_id", "video_id") if "category_id:category" in frame.columns else frame
    out = frame.orderBy(rank_col).coalesce(1).drop(rank_col)
    out.write.option("header", True).option("escape", '"').mode(mode).csv(path)


def write_text_by_category(
    df: DataFrame, path: str, rank_col: str = "rank", line_col: str = "line", mode: str = "overwrite"
) -> None:
    """``<n>: <line>`` text files under ``category_id=<id>/``. A large
    category is range-split over several files, each in rank order; part
    files read in name order give the whole ranked list."""
    (
        df.repartitionByRange("category_id", rank_col)
        .sortWithinPartitions("category_id", rank_col)
        .select("category_id", single_line(ranked_line(rank_col, line_col)).alias("value"))
        .write.partitionBy("category_id")
        .mode(mode)
        .text(path)
    )


def tuple_lines(df: DataFrame) -> DataFrame:
    """Each row as ``(a,b,...)`` text, the way key/value pairs print."""
    return df.select(
        F.concat(F.lit("("), F.concat_ws(",", *[F.col(c).cast("string") for c in df.columns]), F.lit(")")).alias(
            "value"
        )
    )


def write_table(df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite") -> None:
    """Plain directory output: ``csv`` (with header), ``parquet``, ``text``
    (one string column) or ``tuple`` (``(k,v)`` lines)."""
    if fmt == "csv":
        df.write.option("header", True).option("escape", '"').mode(mode).csv(path)
    elif fmt == "parquet":
        df.write.mode(mode).parquet(path)
    elif fmt == "text":
        df.select(single_line(F.col(df.columns[0]))).write.mode(mode).text(path)
    elif fmt == "tuple":
        tuple_lines(df).write.mode(mode).text(path)
    else:
        raise ValueError(f"unknown format {fmt!r}")


def write_clean_table(records: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Store validated, typed records as Parquet partitioned by category id.

    Parse and validate the CSV once; later queries read the typed columns
    they need (column pruning), push ``category_id IN (...)`` and date
    predicates into the scan, and skip whole category directories
    (partition pruning). The rows are rebalanced by category: AQE merges
    small categories into few files and splits a hot one over many tasks.
    """
    records.hint("rebalance", "category_id").write.partitionBy("category_id").mode(mode).parquet(path)


def snapshot_csv_frame(records: DataFrame, trending_date_format: str = "yyyy-MM-dd") -> DataFrame:
    """Typed records back in the 16-column CSV layout (columns that the
    record schema does not carry get neutral values)."""
    return records.select(
        F.col("video_id"),
        F.date_format("trending_date", trending_date_format).alias("trending_date"),
        F.col("title"),
        F.col("channel_title"),
        F.col("category_id").cast("string").alias("category_id"),
        F.date_format("publish_date", "yyyy-MM-dd'T'00:00:00.000'Z'").alias("publish_time"),
        F.lit("none").alias("tags"),
        F.col("views").cast("string").alias("views"),
        F.col("likes").cast("string").alias("likes"),
        F.col("dislikes").cast("string").alias("dislikes"),
        F.lit("0").alias("comment_count"),
        F.concat(F.lit("thumb/"), F.col("video_id")).alias("thumbnail_link"),
        F.lit("False").alias("comments_disabled"),
        F.lit("False").alias("ratings_disabled"),
        F.lit("False").alias("video_error_or_removed"),
        F.concat(F.lit("snapshot of "), F.col("video_id")).alias("description"),
    )


def write_snapshot_csv(
    records: DataFrame, path: str, trending_date_format: str = "yyyy-MM-dd", mode: str = "overwrite"
) -> None:
    """Write records as trending CSV files (header, quoted where needed)."""
    frame = snapshot_csv_frame(records, trending_date_format)
    frame.write.option("header", True).option("escape", '"').mode(mode).csv(path)
