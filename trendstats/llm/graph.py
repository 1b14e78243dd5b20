"""Distributed connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendstats.llm.common import cut


def _state(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(
            F.count(F.lit(1)),
            F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0)),
        ).first()
    )


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for the undirected edges ``(a, b)``; the
    component is its smallest node. Nodes may be of any orderable type.

    Alternates the large-star and small-star steps (each links nodes to the
    smallest neighbour) until the edge set stops changing; about log(n)
    rounds, each cut to the shared checkpoint folder. A hub is never
    gathered: its smallest neighbour comes from a partial aggregation and
    goes back by a join that AQE may split. Null ends and loops are ignored
    (a loop's node is its own component and is not listed); an empty edge
    table gives an empty result. The driver sees two numbers a round.
    """
    e = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    e = cut(e.where(edges["a"].isNotNull() & edges["b"].isNotNull() & (F.col("a") != F.col("b"))).distinct())
    state = _state(e)
    while state[0]:
        # large star: larger neighbours of a node move to its smallest one
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (
            both.join(low, "a").where(F.col("b") > F.col("a"))
            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        )
        # small star: smaller neighbours and the node itself link to the smallest
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = cut(small.union(low.select("a", F.col("m").alias("b"))).distinct())
        after = _state(e)
        if after == state:
            break
        state = after
    stars = e.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.union(e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
