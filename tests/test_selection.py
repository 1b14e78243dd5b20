"""Top-k per group: exact, and with few rows shuffled."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from trendstats.operators import rank

BY = ["g"]


def order():
    return [F.desc("m"), F.asc("id")]


def grouped(spark, n=60_000, groups=4, parts=8):
    """A third of all rows in group 0, distinct metrics, a group of nulls."""
    m = F.pmod(F.xxhash64("id"), F.lit(1 << 40))
    g = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise((F.col("id") % groups).cast("int"))
    return spark.range(0, n, 1, parts).select("id", F.when(F.col("id") % 1000 != 7, g).alias("g"), m.alias("m"))


def expected(df, k):
    rows = {}
    for r in sorted(df.collect(), key=lambda r: (r.m is None, -(r.m or 0), r.id)):
        rows.setdefault(r.g, []).append(r.id)
    return {(g, i + 1): x for g, ids in rows.items() for i, x in enumerate(ids[:k])}


def got(df, k, **options):
    return {(r.g, r.rank): r.id for r in rank.topk_within(df, BY, order(), k, **options).collect()}


def shuffled_rows(df) -> int:
    """Rows written by the exchanges of a query, from its plan's metrics."""
    df.collect()
    total, seen, todo = 0, set(), [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif kind == "ShuffleQueryStageExec":
            todo.append(node.plan())
        elif kind != "ReusedExchangeExec":
            if kind == "ShuffleExchangeExec" and node.id() not in seen:
                seen.add(node.id())
                total += node.metrics().get("shuffleRecordsWritten").get().value()
            children = node.children()
            todo += [children.apply(i) for i in range(children.size())]
    return total


@pytest.mark.parametrize("partitions", [8, 2_000, 20_000])
def test_small_k_shuffles_k_rows_a_group_and_task(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    df = grouped(spark)
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        top = rank.topk_within(df, BY, order(), 5)
        # 8 tasks and 5 groups: once into the first level, again into the second
        assert shuffled_rows(top) <= 2 * 8 * 5 * 5
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("k", [0, 1, 5, 999])
def test_small_k_is_exact(spark, k):
    df = grouped(spark, 20_000)
    assert got(df, k) == expected(df, k)


@pytest.mark.parametrize("k", [1_000, 1_500, 8_000, 100_000])
def test_large_k_is_exact(spark, k):
    df = grouped(spark, 40_000)
    assert got(df, k, metric="m") == expected(df, k)


@pytest.mark.parametrize("k", [1_000, 5_000])
def test_large_k_moves_a_small_multiple_of_k(spark, k):
    df = grouped(spark, 300_000)
    kept = {r.g: r["count"] for r in rank.reaching_top(df, BY, "m", k).groupBy("g").count().collect()}
    sizes = {r.g: r["count"] for r in df.groupBy("g").count().collect()}
    assert sizes[0] > 100_000 and set(kept) == set(sizes)
    for g, n in kept.items():
        assert min(k, sizes[g]) <= n <= rank.SLACK * k or n == sizes[g] <= rank.SLACK * k


def test_ties_nulls_and_few_rows(spark):
    tied = grouped(spark, 30_000).withColumn("m", F.when(F.col("id") % 11 == 0, None).otherwise(F.col("m") % 3))
    assert got(tied, 2_000, metric="m") == expected(tied, 2_000)
    nulls = grouped(spark, 3_000).withColumn("m", F.when(F.col("id") % 50 == 0, F.col("m")))
    assert got(nulls, 1_200, metric="m") == expected(nulls, 1_200)
    empty = grouped(spark, 10).where("id < 0")
    assert got(empty, 1_200, metric="m") == {}


def test_a_floor_too_high_falls_back(spark, monkeypatch):
    monkeypatch.setattr(rank, "SKETCH_ERROR", -0.03)  # aims above the k-th row
    df = grouped(spark, 60_000)
    assert got(df, 1_000, metric="m") == expected(df, 1_000)


def test_several_columns_of_a_group(spark):
    df = grouped(spark, 20_000).withColumn("h", F.concat(F.lit("x"), (F.col("id") % 2).cast("string")))
    top = rank.topk_within(df, ["g", "h"], order(), 1_100, metric="m").collect()
    want = {}
    for r in sorted(df.collect(), key=lambda r: (-r.m, r.id)):
        want.setdefault((r.g, r.h), []).append(r.id)
    assert {(r.g, r.h, r["rank"]): r.id for r in top} == {(*g, i + 1): x for g, ids in want.items() for i, x in enumerate(ids[:1_100])}
