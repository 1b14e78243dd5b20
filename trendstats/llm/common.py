"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendstats.session import ensure_checkpoint_dir


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it from there:
    later steps reuse it and do not depend on a live executor."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spare(df: DataFrame, name: str) -> str:
    """``name``, or ``name`` with underscores added until no column of
    ``df`` has it (whatever the case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def partitions_for(rows: int, per_partition: int, least: int = 1) -> int:
    return max(least, math.ceil(rows / per_partition))


def lowest(df: DataFrame, n: int, key: Column, *ties) -> DataFrame:
    """The ``n`` distinct rows of ``df`` (all, if fewer) that come first by
    the hash ``key`` (a long, spread evenly), then by ``ties``; cut.

    A bound on the key lets about ``2 * n`` rows through before anything is
    sorted, so that no task gets ``n`` rows from every other; should they be
    too few (rows that repeat), the bound is raised.
    """
    share = 2.0 * n / max(1, df.count())
    while True:
        some = df if share >= 1 else df.where(key < F.lit(int((share - 0.5) * 2.0**64)))
        found = cut(some.distinct().orderBy(key, *ties).limit(n))
        if share >= 1 or found.count() == n:
            return found
        share *= 8


def topmost(df: DataFrame, n: int, *order, tasks: int | None = None, fan: int = 16) -> DataFrame:
    """The first ``n`` rows of ``df`` in a total ``order``. Each task keeps
    ``n`` rows, and ``fan`` tasks at a time (some more by chance) are merged
    into one until about ``fan`` are left for the last sort; ``tasks`` is the
    number of partitions of ``df`` (by default that of a shuffle)."""
    conf = df.sparkSession.conf
    if tasks is None:
        first = conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
        tasks = int(first or conf.get("spark.sql.shuffle.partitions"))
    columns = [F.col(f"`{c}`") for c in df.columns]
    group, place = spare(df, "__group"), spare(df, "__place")

    def firsts(rows: DataFrame) -> DataFrame:
        # the low 33 bits of the id are the row's place in its task
        sorted_ = rows.sortWithinPartitions(*order)
        placed = sorted_.withColumn(place, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
        return placed.where(F.col(place) < n).select(*columns)

    groups = math.ceil(tasks / fan)
    while groups > 1:
        dealt = firsts(df).withColumn(group, F.spark_partition_id() % groups)
        df = dealt.repartition(groups, group).select(*columns)
        groups = math.ceil(groups / fan)
    return df.orderBy(*order).limit(n)


def ascii_lower(col):
    """Lower-case A-Z and nothing else."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
