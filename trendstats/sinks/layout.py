"""Stored layouts that spare later queries an exchange or most of a scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from trendstats.sources.trending import reject_reason

# --- bucketed by video -------------------------------------------------------

BUCKET_ROWS = 1 << 20  # rows of a bucket, about
MOST_BUCKETS = 100_000  # Spark's own limit


def bucket_count(df: DataFrame, least: int = 1, rows: int | None = None) -> int:
    """Buckets for ``df`` so that each holds about ``rows`` rows, however many
    ``df`` has (up to ``MOST_BUCKETS``): what one task sorts stays the same."""
    return min(MOST_BUCKETS, max(least, -(-df.count() // (rows or BUCKET_ROWS))))


def write_bucketed_table(df: DataFrame, name: str, buckets: int, path: str | None = None, by: str = "video_id") -> DataFrame:
    """Store ``df`` as table ``name`` bucketed and sorted by ``by``; the table.

    Rows of one video lie in one bucket, so the rollup and joins by video of
    tables with the same buckets need no exchange. Each bucket is written by
    one task (buckets * their size = the table): choose them by ``bucket_count``."""
    ready = df.repartition(buckets, by)
    writer = ready.write.mode("overwrite").bucketBy(buckets, by).sortBy(by)
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return df.sparkSession.table(name)


# --- clustered by publish date -----------------------------------------------


def write_dated_table(
    records: DataFrame, path: str, mode: str = "overwrite", partitions: int | None = None, row_group_bytes: int = 32 << 20
) -> None:
    """Validated records as Parquet by category, clustered by publish date:
    range-partitioned and sorted on (category, date, video), so files and row
    groups cover narrow date ranges and their statistics let a date filter
    skip all others. A hot category or day is split over many files."""
    keys = ["category_id", "publish_date", "video_id"]
    ranged = records.repartitionByRange(partitions, *keys) if partitions else records.repartitionByRange(*keys)
    out = ranged.sortWithinPartitions(*keys).write.partitionBy("category_id").mode(mode)
    out.option("parquet.block.size", row_group_bytes).parquet(path)


# --- accepted and rejected rows in one pass ----------------------------------

ROUTES = ("accepted", "rejected")


def write_routed(
    records: DataFrame, path: str, metrics: Sequence[str] = (), need_date: bool = False, display: bool = False, mode: str = "overwrite"
) -> dict[str, int]:
    """Write every record once, to ``route=accepted/`` or, with the first
    failing test as ``reason``, to ``route=rejected/``; the counts
    (``n_read``, ``n_accepted`` and one per reason) come from the same pass."""
    reason, names = reject_reason(records, metrics, need_date, display)
    routed = records.withColumn("reason", reason)
    routed = routed.withColumn("route", F.when(F.col("reason").isNull(), ROUTES[0]).otherwise(ROUTES[1]))
    seen = Observation()
    counts = [F.count(F.lit(1)).alias("n_read"), F.count_if(F.col("reason").isNull()).alias("n_accepted")]
    counts += [F.count_if(F.col("reason") == n).alias(n) for n in names]
    routed.observe(seen, *counts).write.partitionBy("route").mode(mode).parquet(path)
    return {name: int(n) for name, n in seen.get.items()}


def read_routed(spark: SparkSession, path: str, route: str) -> DataFrame:
    """The accepted or the rejected rows of ``write_routed``."""
    if route not in ROUTES:
        raise ValueError(f"route must be one of {ROUTES}, got {route!r}")
    rows = spark.read.parquet(path).where(F.col("route") == route).drop("route")
    return rows.drop("reason") if route == ROUTES[0] else rows


# --- ranked lists that are read by page --------------------------------------


def write_ranked_list(df: DataFrame, path: str, by: Sequence[str], order: Sequence[Column], partitions: int | None = None) -> None:
    """Store ``df`` in ``order`` within each group, so that any run of ranks is
    read from the files that hold it.

    ``data/`` is range-partitioned and sorted on (group, order): every file
    holds one run of a group's list (a hot group has many files). ``index/``
    has a row per group and file: its first rank, rows and first row number in
    the file, from prefix sums over the files' counts. Ranks are not stored:
    a row's rank is the file's first rank plus its row number."""
    salt = F.xxhash64(F.monotonically_increasing_id()).alias("_salt")  # equal rows spread
    salted = df.select("*", salt)
    keys = [F.col(c) for c in by] + list(order) + [F.col("_salt")]
    ranged = salted.repartitionByRange(partitions, *keys) if partitions else salted.repartitionByRange(*keys)
    ranged.sortWithinPartitions(*keys).drop("_salt").write.mode("overwrite").parquet(f"{path}/data")
    spark = df.sparkSession
    runs = spark.read.schema(df.schema).parquet(f"{path}/data").select(*by, "_metadata.file_name", "_metadata.row_index")
    runs = runs.groupBy(*by, "file_name").agg(F.count(F.lit(1)).alias("n"), F.min("row_index").alias("first_row"))
    place = [F.regexp_extract("file_name", r"^part-(\d+)-.*?(?:-c(\d+))", g).cast("long") for g in (1, 2)]
    before = Window.partitionBy(*by).orderBy(*place).rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("n").over(before), F.lit(0)) + 1
    index = runs.select(*by, "file_name", "n", "first_row", first.cast("bigint").alias("first_rank"))
    index.write.mode("overwrite").parquet(f"{path}/index")


def read_ranks(spark: SparkSession, path: str, group: dict, first: int, last: int, name: str = "rank") -> DataFrame:
    """Rows ``first`` to ``last`` of a group of a ranked list, with their rank;
    only the files that hold them are read."""
    own = F.lit(True)
    for column, value in group.items():
        own = own & F.col(column).eqNullSafe(F.lit(value))
    index = spark.read.parquet(f"{path}/index")
    held = (F.col("first_rank") <= last) & (F.col("first_rank") + F.col("n") > first)
    # the files of the asked ranks: bounded by last - first, not by the list
    files = index.where(own & held).select("file_name", "first_row", "first_rank").collect()
    data = spark.read.parquet(*[f"{path}/data/{f['file_name']}" for f in files]) if files else spark.read.parquet(f"{path}/data").limit(0)
    start = F.create_map(*[F.lit(x) for f in files for x in (f["file_name"], f["first_rank"] - f["first_row"])]) if files else F.lit(None)
    offset = start[F.col("_metadata.file_name")] if files else F.lit(0)
    ranked = data.where(own).select("*", (F.col("_metadata.row_index") + offset).cast("bigint").alias(name))
    return ranked.where(F.col(name).between(first, last))
