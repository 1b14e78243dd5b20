"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Sizes are word counts. Each source has a target in words (``targets``). A
source's whole epochs are taken first (target // size times every document);
the rest is a weighted sample without replacement: every document draws an
exponential key ``-ln(u) / quality weight``, the documents of a source are
taken in key order, and a prefix sum of sizes stops at the rest of the
budget. The one document that meets the end of the budget is taken in part,
so a source misses its target by less than one word.

The key comes from a hash of the id and the seed: reruns agree.

Scale: one pass counts the words into a slim table that is cut to the
shared checkpoint folder. The prefix sum never sorts a source in one task:
keys are mapped to (0, 1) and dealt into equal buckets (about
``bucket_rows`` rows each in a source that holds all rows); bucket sums give
the bucket that holds the end of the budget, and only that bucket's rows of
each source are sorted. Tables of sources come from partial aggregation; the
driver sees three numbers a round of the target computation.

Defined cases: a null or empty text has size 0; a null source is a source of
its own (the last); documents of size 0 are taken 0 words; null ids share
one key and are ordered by size; repeated rows count each; an empty table
gives an empty result; other columns are ignored; a weight that is null or
not positive counts as the smallest weight, 1e-6.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendstats.llm.common import cut, partitions_for

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
_UNIT = float(1 << 48)


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def numbered_sources(sizes: DataFrame) -> DataFrame:
    """``position`` 0.. of the sources in code-point order, null last.

    Range-partitioned; the rows before a partition come from the counts of
    the partitions (a table with a row a partition)."""
    ranged = cut(
        sizes.repartitionByRange(F.asc_nulls_last("source")).sortWithinPartitions(F.asc_nulls_last("source"))
        .withColumn("part", F.spark_partition_id())
        .withColumn("at", F.monotonically_increasing_id())
    )
    counts = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("part", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return ranged.join(counts, "part").select(
        *sizes.columns, (F.col("before") + F.col("at") - F.col("first")).alias("position")
    )


def targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """``(source, source_size, target)`` for ``(source, source_size)`` rows.

    The budget ``share * all sizes`` is split by weight; a source above
    ``most`` times its size is held there and the excess is shared again by
    weight among the others until none is above. Each round is one partial
    aggregation over the sources; it ends when no further source is held.
    """
    named = numbered_sources(sizes)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("position") % len(weights) + 1).cast("int"))
    table = cut(named.select("source", "source_size", weight.alias("w"), (F.col("source_size") * F.lit(most)).alias("cap")))
    budget = share * float(table.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("n")).first()["n"])
    rate, held = 0.0, -1
    while True:
        over = F.col("cap") <= F.col("w") * F.lit(rate)
        row = table.agg(
            F.coalesce(F.sum(F.when(over, F.col("cap"))), F.lit(0.0)).alias("capped"),
            F.coalesce(F.sum(F.when(~over, F.col("w"))), F.lit(0.0)).alias("w"),
            F.count_if(over).alias("n"),
        ).first()
        if row["n"] == held or not row["w"]:
            break
        held, rate = row["n"], (budget - row["capped"]) / row["w"]
    return table.select("source", "source_size", F.least("cap", F.col("w") * F.lit(rate)).alias("target"))


def _unit(key: Column) -> Column:
    """A number in (0, 1) from 48 bits of the md5 of ``key``."""
    bits = F.conv(F.substring(F.md5(key), 1, 12), 16, 10).cast("double")
    return (bits + F.lit(0.5)) / F.lit(_UNIT)


def mix(
    docs: DataFrame,
    size: Column | None = None,
    weight: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = WEIGHTS,
    share: float = 1.5,
    most: float = 2.0,
    seed: str = "mix",
    bucket_rows: int = 2_000,
) -> DataFrame:
    """One row per document: ``doc_id``, ``source``, ``size``,
    ``source_size``, ``target`` (of its source) and ``taken`` (words,
    repeats counted). ``size`` defaults to the word count of the text,
    ``weight``, the quality weight, to 1."""
    quality = F.coalesce(weight.cast("double") if weight is not None else F.lit(1.0), F.lit(0.0))
    u = _unit(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(f":{seed}")).cast("binary"))
    slim = cut(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).alias("source"),
            (word_count(F.col(text_col)) if size is None else size.cast("long")).alias("size"),
            (-F.ln(u) / F.greatest(quality, F.lit(1e-6))).alias("key"),
        )
    )
    per_source = slim.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    plan = cut(targets(per_source.select("source", "source_size"), weights, share, most))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = plan.select("*", epochs.cast("long").alias("epochs"))
    rest = F.floor(F.col("target")).cast("long") - F.col("epochs") * F.col("source_size")
    # structs join and group null sources like any other
    plan = plan.select(F.struct("source").alias("s"), "source_size", "target", "epochs", rest.alias("rest"))

    # keys in key order: 1 - exp(-key) grows with the key and stays in (0, 1)
    buckets = partitions_for(slim.count(), bucket_rows)
    bucket = F.least(F.floor((F.lit(1.0) - F.exp(-F.col("key"))) * buckets), F.lit(buckets - 1)).cast("long")
    rows = slim.select(F.struct("source").alias("s"), "doc_id", "source", "size", "key", bucket.alias("bucket"))
    sums = rows.groupBy("s", "bucket").agg(F.sum("size").alias("in_bucket"))
    before = Window.partitionBy("s").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("s", "bucket", "in_bucket", F.coalesce(F.sum("in_bucket").over(before), F.lit(0)).alias("before"))
    # what each bucket of a source gets: documents meet it by (source,
    # bucket), so a source of any size is spread over its buckets
    marks = sums.join(plan, "s").withColumn(
        "ends", (F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("in_bucket"))
    )
    joined = rows.join(marks, ["s", "bucket"])
    own = Window.partitionBy("s", "bucket").orderBy("key", F.asc_nulls_last("doc_id"), "size")
    split = joined.where("ends")
    split = split.withColumn("sum_to", F.sum("size").over(own.rowsBetween(Window.unboundedPreceding, 0)) + F.col("before"))
    in_part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("sum_to") + F.col("size")))
    whole = joined.where("not ends")
    in_whole = F.when(F.col("before") < F.col("rest"), F.col("size")).otherwise(0)

    def out(df: DataFrame, extra: Column) -> DataFrame:
        return df.select(
            "doc_id", "source", "size", "source_size", "target",
            (F.col("epochs") * F.col("size") + extra).cast("long").alias("taken"),
        )

    return out(whole, in_whole).union(out(split, in_part))
