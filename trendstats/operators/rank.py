"""Ordering, top-k and per-category numbering.

* Global top-k: ``orderBy(...).limit(k)``, planned as
  ``TakeOrderedAndProject`` (each task keeps k rows; no full sort).
* Top-k per group, small k: ``row_number() <= k`` per (group, task that read
  the rows), then per group, so what is shuffled is k rows a group and task,
  whatever the number of shuffle partitions.
* Top-k per group, large k: quantile sketches give each group a floor that
  its first k rows reach and few others; only those are shuffled
  (``reaching_top``), and no task holds a group.
* Full per-group numbering (``number_within``): a range-partitioned sort
  plus prefix counts, so a group larger than one task is split across
  many tasks instead of being gathered into one window partition.

Every ordering ends in tie-breaks on the output columns, so results are
the same on every run.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendstats.functions.columns import dated_line, display_line
from trendstats.operators.joins import in_categories, with_category
from trendstats.operators.select import published_in, published_since
from trendstats.schema import VIDEO_COLUMNS, check_metric
from trendstats.session import ensure_checkpoint_dir
from trendstats.sources.trending import valid_records

# Largest k that Spark limits in the tasks before a window's exchange
# (``spark.sql.optimizer.windowGroupLimitThreshold`` is 1000).
WINDOW_K = 999
# Groups of tasks whose first k rows are merged before those of all tasks.
MERGE_FAN = 1024
# KLL parameter of the quantile sketches (about 25 KB each) and twice the share
# of a group's rows by which their ranks err.
SKETCH_SIZE = 1024
SKETCH_ERROR = 0.01
# Shares of a group that sketches are asked for: 2^(-i / SHARE_STEPS), down to
# about SKETCH_ERROR.
SHARE_STEPS = 4
SHARES = [2 ** (-i / SHARE_STEPS) for i in range(32)]
# A floor is refined until at most SLACK * k rows of a group reach it.
SLACK = 2
# Largest per-partition table of ``number_within`` that is broadcast.
STATS_BYTES = 64 << 20

# Record columns used as tie-breaks after the metric.
RECORD_TIEBREAK = (
    "video_id",
    "trending_date",
    "title",
    "channel_title",
    "publish_date",
    "views",
    "likes",
    "dislikes",
)


def _video_columns(df: DataFrame) -> list[str]:
    """Video output columns present in ``df`` (``category`` only when the
    rollup was given a dimension, the date text only when the source has it)."""
    return [c for c in (*VIDEO_COLUMNS, "trending_date_text") if c in df.columns]


def _check_k(k: int) -> int:
    if k < 0:
        raise ValueError(f"k must be >= 0, got {k}")
    return int(k)


def topk(df: DataFrame, order: Sequence[Column], k: int, name: str = "rank") -> DataFrame:
    """The first ``k`` rows in ``order``, numbered 1..k."""
    top = df.orderBy(*order).limit(_check_k(k))
    # Numbering k rows after the limit: a single small partition by design.
    return top.withColumn(name, F.row_number().over(Window.orderBy(*order)).cast("bigint"))


def topk_within(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int, name: str = "rank", metric: str | None = None
) -> DataFrame:
    """The first ``k`` rows of each group in ``order``, numbered 1..k.

    Up to ``WINDOW_K`` the window's group limit keeps k rows of a group in
    each task before anything moves. The tasks' rows are merged in two levels
    (tasks modulo ``MERGE_FAN``, then all), so a task meets at most
    ``MERGE_FAN`` * k rows of a group, or k from each task of its level.

    A larger k takes the rows that reach a floor of the bigint ``metric``
    whose descending order leads ``order`` (``reaching_top``), which need not
    fit one task and are numbered by ``number_within``; without a metric all
    rows are."""
    k = _check_k(k)
    if k > WINDOW_K:
        kept = df if metric is None else reaching_top(df, by, metric, k)
        return number_within(kept, by, order, name).where(F.col(name) <= k)
    level = df.withColumn("_level", F.spark_partition_id() % MERGE_FAN)
    w = Window.partitionBy(*by, "_level").orderBy(*order)
    kept = level.withColumn("_at", F.row_number().over(w)).where(F.col("_at") <= k).drop("_level", "_at")
    ranked = kept.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    return ranked.where(F.col(name) <= k).withColumn(name, F.col(name).cast("bigint"))


def _small(table: DataFrame, by: Sequence[str]) -> bool:
    """Is a table of numbers per group under ``STATS_BYTES``?"""
    width = 64 + sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 16 for c in by), F.lit(0))
    return table.agg(F.coalesce(F.sum(width), F.lit(0)).alias("b")).first()["b"] <= STATS_BYTES


def _matched(df: DataFrame, table: DataFrame, by: Sequence[str], how: str = "inner") -> DataFrame:
    """``df`` with a broadcast table's row for its group (null-safe)."""
    right = table.select(*[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)], *[c for c in table.columns if c not in by])
    cond = F.lit(True)
    for i, c in enumerate(by):
        cond = cond & F.col(c).eqNullSafe(F.col(f"_by{i}"))
    return df.join(F.broadcast(right), cond, how).drop(*[f"_by{i}" for i in range(len(by))])


def top_floors(df: DataFrame, by: Sequence[str], metric: str, k: int) -> DataFrame:
    """``_floor`` per group: at least min(k, all) rows of the group have a
    ``metric`` not below it (null: the group needs no floor).

    A pass sketches the groups' quantiles (KLL, merged like any partial
    aggregate: nothing but sketches moves) and puts the floor where k rows
    and the sketch's error lie above; the next pass counts exactly what
    reaches it and sketches that. A floor that fewer than k rows reach, which
    the error margin makes unlikely, falls back to the one before. A group is
    done when at most ``SLACK`` * k rows reach its floor, or when equal values
    leave nothing to refine. n rows take about log(n / k) / log(1 /
    ``SKETCH_ERROR``) passes over two columns; the driver sees one number a
    pass."""
    slim = df.select(*by, metric)
    n, floor = F.count(metric), F.col("_floor")
    sketch = F.kll_sketch_agg_bigint(metric, F.lit(SKETCH_SIZE))

    def higher(stats: DataFrame) -> DataFrame:
        """The floor that the sketch suggests (null: no higher one)."""
        share = (F.lit(k) + F.col("_n") * F.lit(SKETCH_ERROR)) / F.col("_n")
        # the sketch takes constant ranks only: the next larger share of a grid
        step = F.floor(-F.log2(share) * F.lit(SHARE_STEPS)).cast("int")
        value = F.get(F.kll_sketch_get_quantile_bigint("_s", F.array(*[F.lit(1 - s) for s in SHARES])), step)
        wanted = (F.col("_n") > SLACK * k) & (share < 1)
        return stats.withColumn("_next", F.when(wanted, value)).drop("_s")

    ensure_checkpoint_dir(df.sparkSession)
    floors = higher(slim.groupBy(*by).agg(n.alias("_n"), sketch.alias("_s"))).select(
        *by, F.lit(None).cast("bigint").alias("_floor"), "_next"
    ).checkpoint(eager=True)
    while floors.where("_next is not null").limit(1).count():
        if not _small(floors, by):
            raise ValueError("more groups than a broadcast table may hold")
        rows = _matched(slim, floors.where("_next is not null"), by).where(F.col(metric) >= F.col("_next"))
        counted = higher(rows.groupBy(*by).agg(n.alias("_n"), sketch.alias("_s"))).withColumnRenamed("_next", "_after")
        known = _matched(floors, counted, by, "left")
        enough = F.col("_n") >= k
        moved = F.when(enough & (F.col("_after") > F.col("_next")), F.col("_after"))
        floors = known.select(
            *by, F.when(enough, F.col("_next")).otherwise(floor).alias("_floor"), moved.alias("_next")
        ).checkpoint(eager=True)
    return floors.select(*by, "_floor")


def reaching_top(df: DataFrame, by: Sequence[str], metric: str, k: int) -> DataFrame:
    """The rows of each group that reach its floor (``top_floors``): the first
    k by descending ``metric``, their ties, and at most about ``SLACK`` * k in
    all where values differ. One pass; rows stay in the tasks that read them.
    Rows without a metric stay only in groups that need them."""
    floors = top_floors(df, by, metric, k)
    kept = _matched(df, floors, by).where(F.col("_floor").isNull() | (F.col(metric) >= F.col("_floor")))
    return kept.drop("_floor").checkpoint(eager=True)


def number_within(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[Column],
    name: str = "rank",
    partitions: int | None = None,
) -> DataFrame:
    """Number every row 1..n within its group in ``order``, without putting a
    group into one task.

    1. Range-partition on (group, order, a hashed row number) and sort inside
       partitions; a hot group spans many partitions, and so do rows that are
       equal in group and order. Each row gets its partition id and its
       position in the partition.
    2. The tagged rows are checkpointed to the shared checkpoint folder,
       which fixes the partition boundaries (range bounds come from a
       sample) and cuts the lineage.
    3. Per (partition, group): row count and first position; a running sum
       over partitions gives the rows of the group in earlier partitions.
       This table has at most partitions + groups rows; it is checkpointed
       too and broadcast while it is under ``STATS_BYTES``.
    4. rank = rows before + (position − first position) + 1.
    """
    salted = df.withColumn("_salt", F.xxhash64(F.monotonically_increasing_id()))
    keys = [F.col(c) for c in by] + list(order) + [F.col("_salt")]
    # Without an explicit count AQE sizes the range partitions.
    ranged = salted.repartitionByRange(partitions, *keys) if partitions else salted.repartitionByRange(*keys)
    tagged = (
        ranged
        .sortWithinPartitions(*keys)
        .drop("_salt")
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id())
    )
    ensure_checkpoint_dir(df.sparkSession)
    tagged = tagged.checkpoint(eager=True)
    stats = tagged.groupBy("_part", *by).agg(F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_first"))
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.select(
        "_part", *[F.col(c).alias(f"_s_{c}") for c in by], "_first",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
    )
    # Checkpointed so that the size check and the join below read it.
    stats = stats.withColumnRenamed("_part", "_s_part").checkpoint(eager=True)
    small = _small(stats, [f"_s_{c}" for c in by])
    cond = F.col("_part") == F.col("_s_part")
    for c in by:
        cond = cond & F.col(c).eqNullSafe(F.col(f"_s_{c}"))
    joined = tagged.join(F.broadcast(stats) if small else stats, cond, "inner")
    rank = (F.col("_before") + F.col("_pos") - F.col("_first") + 1).cast("bigint")
    return joined.select(*df.columns, rank.alias(name))


# --- video grain (menus 3-12) -----------------------------------------------


def filter_videos_by_category(videos: DataFrame, ids: Sequence[int] | None) -> DataFrame:
    """Chosen categories' videos, by category then views descending."""
    return in_categories(videos, ids).orderBy("category_id", F.desc("views"), "video_id")


def topk_videos_by_category(
    videos: DataFrame, metric: str, k: int, ids: Sequence[int] | None = None
) -> DataFrame:
    """Top ``k`` videos by ``metric`` in each chosen category."""
    m = check_metric(metric)
    v = in_categories(videos, ids)
    return topk_within(v, ["category_id"], [F.desc(m), F.asc("video_id")], k, metric=m).select(
        *_video_columns(v), "rank"
    )


def topk_videos(
    videos: DataFrame, metric: str, k: int, ids: Sequence[int] | None = None, year: int | None = None
) -> DataFrame:
    """Top ``k`` videos by ``metric`` over all chosen categories together,
    optionally only those published in ``year``."""
    m = check_metric(metric)
    v = in_categories(videos, ids)
    if year is not None:
        v = published_in(v, year)
    return topk(v, [F.desc(m), F.asc("video_id")], k).select(*_video_columns(v), "rank")


# --- record grain (standalone jobs) -----------------------------------------

RECORD_OUT = (
    "category_id",
    "category",
    "video_id",
    "trending_date",
    "title",
    "channel_title",
    "publish_date",
    "views",
    "likes",
    "dislikes",
)


def sort_records_by_views(
    records: DataFrame, cats: DataFrame, ids: Sequence[int], extra: Sequence[str] = ()
) -> DataFrame:
    """Focus-category records with a view count, views ascending; ``extra``
    names further record columns to keep."""
    valid = in_categories(valid_records(records, metrics=("views",)), ids)
    out = with_category(valid, cats).select(*RECORD_OUT, *extra)
    return out.orderBy("views", "category_id", *[c for c in RECORD_TIEBREAK if c != "views"])


def filter_records_by_category(records: DataFrame, category_id: int) -> DataFrame:
    """One category's display-ready records as display lines."""
    valid = in_categories(valid_records(records, display=True), [category_id])
    return valid.select("category_id", display_line(with_category=False).alias("line"))


def topk_records_by_category(
    records: DataFrame, metric: str, k: int, ids: Sequence[int]
) -> DataFrame:
    """Top ``k`` records (not videos) by ``metric`` per focus category, as
    display lines with the category id. Numeric order."""
    m = check_metric(metric)
    valid = in_categories(valid_records(records, display=True), ids)
    order = [F.desc(m)] + [F.asc(c) for c in RECORD_TIEBREAK if c != m]
    top = topk_within(valid, ["category_id"], order, k, metric=m)
    return top.select("category_id", "rank", F.col(m).alias(m), display_line(with_category=True).alias("line"))


def records_in_range(
    records: DataFrame,
    ids: Sequence[int],
    range_name: str,
    as_of: str | dt.date | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Focus records published in the range, numbered per category by
    publish date ascending, as ``date - url - title:T`` lines."""
    valid = in_categories(valid_records(records, need_date=True), ids)
    lines = published_since(valid, range_name, as_of).select(
        "category_id", "publish_date", dated_line().alias("line")
    )
    numbered = number_within(lines, ["category_id"], [F.asc("publish_date"), F.asc("line")], partitions=partitions)
    return numbered.select("category_id", "rank", "publish_date", "line")
