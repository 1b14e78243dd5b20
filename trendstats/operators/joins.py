"""Category lookups: enrichment, selection lists and their checks.

The category dimension is small by nature, but nothing here assumes it: the
joins carry no hint, so the planner broadcasts the dimension only while its
size in bytes is under ``spark.sql.autoBroadcastJoinThreshold`` (checked
again at run time by AQE) and keeps a shuffled join beyond that.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def with_category(df: DataFrame, cats: DataFrame, name: str = "category") -> DataFrame:
    """Add the category title (``null`` for an id missing from the
    dimension; the row is kept)."""
    return df.join(cats.select("category_id", F.col("title").alias(name)), "category_id", "left")


def titled(df: DataFrame, cats: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add the category title as the last step of a query (after filters
    and top-k, so the lookup touches only the rows that are output) and
    put the columns in the given order."""
    if "category" not in df.columns:
        df = with_category(df, cats)
    return df.select(*columns)


def selection(spark: SparkSession, ids: Sequence[int]) -> DataFrame:
    """``(position, category_id)`` for a chosen id list, positions from 1.

    Built from literals on the executors, no driver-side data. A repeated id
    keeps its first position only.
    """
    unique = list(dict.fromkeys(int(i) for i in ids))
    if not unique:
        raise ValueError("empty category selection")
    arr = F.array(*[F.lit(i) for i in unique])
    rows = spark.range(1).select(F.posexplode(arr).alias("pos0", "category_id"))
    return rows.select((F.col("pos0") + 1).cast("bigint").alias("position"), F.col("category_id"))


def list_categories(cats: DataFrame) -> DataFrame:
    """All categories in id order."""
    return cats.select("category_id", "title").orderBy("category_id")


def selected_categories(spark: SparkSession, ids: Sequence[int], cats: DataFrame) -> DataFrame:
    """Chosen ids that exist in the dimension, numbered 1.. in choice order,
    with their titles (unknown ids are refused, duplicates kept once)."""
    sel = selection(spark, ids)
    known = sel.join(cats.select("category_id", "title"), "category_id", "inner")
    w = Window.orderBy("position")  # the selection is a bounded literal list
    return known.select(
        F.row_number().over(w).cast("bigint").alias("position"), "category_id", "title"
    )


def unknown_categories(spark: SparkSession, ids: Sequence[int], cats: DataFrame) -> DataFrame:
    """Chosen ids missing from the dimension ("no category X")."""
    sel = selection(spark, ids)
    return sel.join(cats.select("category_id"), "category_id", "left_anti").select("category_id")


def in_categories(df: DataFrame, ids: Sequence[int] | None, cats: DataFrame | None = None) -> DataFrame:
    """Rows whose category is one of ``ids``: one ``IN`` predicate, pushed to
    the scan where the column is a scan column.

    With ``cats`` only ids of the dimension count (a semi join), so unknown
    ids are refused; ``ids=None`` means every id of the dimension, or no
    filter at all without ``cats``.
    """
    if ids is not None:
        df = df.where(F.col("category_id").isin(sorted({int(i) for i in ids})))
    return df if cats is None else df.join(cats.select("category_id"), "category_id", "left_semi")
