"""Distributed per-group numbering against a brute-force window, with one
group holding most of the rows (it must span several partitions)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from trendstats.operators import number_within


def make(spark, n=20000):
    # group 1 holds ~3/4 of the rows; duplicates of (g, k) exist
    return spark.range(n).select(
        F.when(F.col("id") % 4 == 0, F.col("id") % 7 + 2).otherwise(1).cast("int").alias("g"),
        ((F.col("id") * 7919) % 5003).alias("k"),
        (F.col("id") % 3).alias("t"),
    )


def test_matches_row_number(spark):
    df = make(spark)
    order = [F.asc("k"), F.desc("t")]
    got = number_within(df, ["g"], order, partitions=16)
    want = df.withColumn("rank", F.row_number().over(Window.partitionBy("g").orderBy(*order)).cast("bigint"))
    a = sorted(tuple(r) for r in got.select("g", "k", "t", "rank").collect())
    b = sorted(tuple(r) for r in want.select("g", "k", "t", "rank").collect())
    assert a == b


def test_hot_group_spans_partitions(spark):
    df = make(spark)
    numbered = number_within(df, ["g"], [F.asc("k"), F.asc("t")], partitions=16)
    # numbers are exactly 1..n per group
    stats = numbered.groupBy("g").agg(F.count("*").alias("n"), F.min("rank").alias("lo"),
                                      F.max("rank").alias("hi"), F.countDistinct("rank").alias("d")).collect()
    for r in stats:
        assert (r.lo, r.hi, r.d) == (1, r.n, r.n)
    hot = next(r for r in stats if r.g == 1)
    assert hot.n == 15000


def test_empty_input(spark):
    df = make(spark).where("g < 0")
    assert number_within(df, ["g"], [F.asc("k")], partitions=4).count() == 0


def test_equal_rows_are_spread(spark):
    """Half the rows are equal in group and order: they span partitions."""
    from pyspark.sql import DataFrame

    df = spark.range(40000, numPartitions=8).select(
        F.lit(1).alias("g"), F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id")).alias("k")
    )
    seen = {}
    keep = DataFrame.checkpoint

    def spy(self, *args, **kwargs):
        out = keep(self, *args, **kwargs)
        if "_pos" in out.columns:
            seen["largest"] = out.groupBy("_part").count().agg(F.max("count")).first()[0]
        return out

    kind = type(df)
    keep = kind.checkpoint
    kind.checkpoint = spy
    try:
        numbered = number_within(df, ["g"], [F.asc("k")], partitions=16)
        assert numbered.agg(F.count_distinct("rank")).first()[0] == 40000
    finally:
        kind.checkpoint = keep
    assert seen["largest"] < 8000
