"""Incremental category totals over a folder that receives trending CSVs.

The batch jobs read a folder of daily snapshot files (``<dir>/*``). As a
stream, each new file adds to per-category running totals: records,
views, likes and dislikes of the focus categories, with the same validity
rules as the batch jobs. The state is one row per category (bounded), so
no watermark is needed; the result is rewritten whole (complete mode)
after each micro-batch through ``foreachBatch`` as a small Parquet table.
The checkpoint folder makes the query restartable after a failure.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from trendstats.operators.joins import in_categories
from trendstats.schema import FOCUS_IDS, RAW_COLUMNS, raw_schema
from trendstats.sources.trending import typed_records, validity


def read_trending_stream(
    spark: SparkSession, directory: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Streaming DataFrame of typed records from CSV files arriving in
    ``directory`` (same columns and ``_malformed`` flag as ``read_trending``)."""
    reader = (
        spark.readStream.schema(raw_schema("_corrupt"))
        .option("header", True)
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt")
        .option("columnPruning", False)
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.csv(directory)
    raw = raw.select(
        *RAW_COLUMNS, (F.col("_corrupt").isNotNull() | F.col("video_id").isNull()).alias("_malformed")
    )
    return typed_records(raw)


def category_totals(records: DataFrame, ids: Sequence[int] | None = FOCUS_IDS) -> DataFrame:
    """Per category: usable records, and views / likes / dislikes summed
    over the records whose numbers are usable for that sum. Works on a
    batch or a streaming DataFrame."""
    ok = validity(records)
    ok_views = validity(records, ("views",))
    ok_ld = validity(records, ("likes", "dislikes"))
    chosen = in_categories(records.where(ok), ids)
    return chosen.groupBy("category_id").agg(
        F.count(F.lit(1)).alias("n_records"),
        F.sum(F.when(ok_views, F.col("views"))).alias("views"),
        F.sum(F.when(ok_ld, F.col("likes"))).alias("likes"),
        F.sum(F.when(ok_ld, F.col("dislikes"))).alias("dislikes"),
    )


def start_category_totals(
    spark: SparkSession,
    directory: str,
    output_path: str,
    checkpoint_path: str,
    ids: Sequence[int] | None = FOCUS_IDS,
    available_now: bool = False,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Start the running-totals query. ``available_now=True`` processes the
    files present and stops (a scheduled incremental job)."""
    totals = category_totals(read_trending_stream(spark, directory), ids)

    def publish(batch: DataFrame, _batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(output_path)

    writer = totals.writeStream.outputMode("complete").foreachBatch(publish).option(
        "checkpointLocation", checkpoint_path
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
