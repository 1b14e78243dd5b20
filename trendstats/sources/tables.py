"""Adapter: the driver's star-schema parquet tables → record schema.

One row per (video, trending day): the video is the part, the trending day
the ship date, the channel the supplier, the category the brand number, and
the metrics come from the line item. The category dimension is the nation
table. Both scans read only the columns used (parquet column pruning).

The two joins are planned by the optimizer: it broadcasts ``part`` and
``supplier`` only while their measured size is under
``spark.sql.autoBroadcastJoinThreshold`` (checked again at run time by AQE)
and falls back to a shuffled sort-merge join beyond it, which is what a
100 TB ``lineitem`` against a billion-row ``part`` needs.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendstats.sources.categories import categories_from_table

PUBLISH_EPOCH = dt.date(1995, 1, 1)


# Schemas by session and path: a table read by many queries has its footers
# read once. Only the schema is kept; files are listed anew by each query.
_SCHEMAS: dict[tuple[str, str], T.StructType] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _SCHEMAS:
        _SCHEMAS[key] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[key]).parquet(path)


def calendar_date(df: DataFrame, name: str) -> Column:
    """Calendar date of a timestamp column stored without a time zone,
    whatever the session time zone: a ``timestamp_ntz`` casts directly; a
    column read as an instant is taken as UTC wall-clock time."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.TimestampType):
        micros_per_day = 86_400_000_000
        return F.date_from_unix_date(F.floor(F.unix_micros(F.col(name)) / micros_per_day).cast("int"))
    return F.col(name).cast("date")


def trending_from_tables(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """The record view; ``keep`` names line item columns to carry along."""
    lineitem = _table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity", "l_linenumber", *keep
    )
    part = _table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    supplier = _table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    joined = lineitem.join(part, lineitem.l_partkey == part.p_partkey).join(
        supplier, lineitem.l_suppkey == supplier.s_suppkey
    )
    return joined.select(
        F.concat(F.lit("v"), F.col("l_partkey").cast("string")).alias("video_id"),
        calendar_date(lineitem, "l_shipdate").alias("trending_date"),
        F.col("p_name").alias("title"),
        F.col("s_name").alias("channel_title"),
        F.substr(F.col("p_brand"), F.lit(7)).try_cast("int").alias("category_id"),
        F.date_add(F.lit(PUBLISH_EPOCH), (F.col("l_partkey") % 2000).cast("int")).alias("publish_date"),
        F.floor(F.col("l_extendedprice")).cast("bigint").alias("views"),
        F.floor(F.col("l_quantity")).cast("bigint").alias("likes"),
        F.col("l_linenumber").cast("bigint").alias("dislikes"),
        *keep,
    )


def categories_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return categories_from_table(_table(spark, sf_dir, "nation"), "n_nationkey", "n_name")
