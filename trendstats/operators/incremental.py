"""The video rollup as a stored state into which batches of snapshots merge.

A state folder holds

* ``parts/version=<v>/bucket=<b>/``: one mergeable row per video
  (``aggregate.video_parts``), videos dealt to buckets by a hash of their id;
* ``manifest/version=<v>/``: which version's files are current for each
  bucket, and the names of the batches that are in.

A merge aggregates the new snapshots alone, reads only the buckets that their
videos fall into, writes those buckets anew under the next version and then the
manifest, whose ``_SUCCESS`` file is the commit: a reader sees the old state or
the new one, a merge that dies half-way leaves files that no manifest names,
and of two merges at once the second fails on the manifest of the first. A
batch that is already in changes nothing, so a day may be replayed.

Scale: a merge moves one row per video of the batch and of the touched buckets,
in one exchange by bucket; the history of snapshots is never read again. The
driver handles at most a row per bucket and batch name.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendstats.operators.aggregate import video_parts, videos_of_parts
from trendstats.schema import METRICS
from trendstats.session import children, ensure_checkpoint_dir, exists, remove

BUCKETS = 1024
_MANIFEST = "buckets int, bucket int, at long, batch string"


def bucket_of(video_id: str | Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(video_id) if isinstance(video_id, str) else video_id), F.lit(buckets)).cast("int")


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Committed versions, oldest first."""
    folder = f"{path.rstrip('/')}/manifest"
    found = [name for name in children(spark, folder) if name.startswith("version=")]
    return sorted(int(n.split("=")[1]) for n in found if exists(spark, f"{folder}/{n}/_SUCCESS"))


def _manifest(spark: SparkSession, path: str) -> tuple[int, int | None, dict[int, int], set[str]]:
    """(version, number of buckets, bucket → version of its files, batches);
    version 0 is a state that does not exist yet."""
    versions = _versions(spark, path)
    if not versions:
        return 0, None, {}, set()
    rows = spark.read.schema(_MANIFEST).parquet(f"{path.rstrip('/')}/manifest/version={versions[-1]}").collect()
    return versions[-1], rows[0]["buckets"], {r["bucket"]: r["at"] for r in rows if r["batch"] is None}, {r["batch"] for r in rows if r["batch"] is not None}


def _files(path: str, current: dict[int, int], buckets: Iterable[int]) -> list[str]:
    return [f"{path.rstrip('/')}/parts/version={current[b]}/bucket={b}" for b in sorted(buckets)]


def merge_batch(
    spark: SparkSession, path: str, records: DataFrame, batch: str, buckets: int = BUCKETS, wide: bool = False
) -> list[int]:
    """Merge the snapshots ``records`` under the name ``batch``; the buckets
    that were written (none when the batch is already in). ``buckets`` and
    ``wide`` are fixed by the first merge."""
    version, known, current, batches = _manifest(spark, path)
    if batch in batches:
        return []
    buckets = known or buckets
    ensure_checkpoint_dir(spark)
    parts = video_parts(records, wide).withColumn("bucket", bucket_of("video_id", buckets)).checkpoint(eager=True)
    touched = [r["bucket"] for r in parts.select("bucket").distinct().collect()]
    merged = parts
    if old := _files(path, current, set(touched) & set(current)):
        merged = spark.read.schema(parts.drop("bucket").schema).parquet(*old).withColumn("bucket", bucket_of("video_id", buckets))
        merged = merged.unionByName(parts)
        total = [F.sum(m).cast(parts.schema[m].dataType).alias(m) for m in METRICS]
        merged = merged.repartition("bucket").groupBy("bucket", "video_id").agg(*total, F.min("_pick").alias("_pick"))
    else:
        merged = merged.repartition("bucket")
    if touched:
        merged.write.mode("overwrite").partitionBy("bucket").parquet(f"{path.rstrip('/')}/parts/version={version + 1}")
    current = current | {b: version + 1 for b in touched}
    rows = [(buckets, b, at, None) for b, at in sorted(current.items())] + [(buckets, None, None, n) for n in sorted(batches | {batch})]
    spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.parquet(f"{path.rstrip('/')}/manifest/version={version + 1}")
    return sorted(touched)


def read_videos(spark: SparkSession, path: str) -> DataFrame:
    """The state as video rows (those of ``rollup_videos`` without titles)."""
    _, _, current, _ = _manifest(spark, path)
    if not current:
        raise ValueError(f"no rollup state with videos in {path}")
    return videos_of_parts(spark.read.parquet(*_files(path, current, current)))


def merged_batches(spark: SparkSession, path: str) -> list[str]:
    return sorted(_manifest(spark, path)[3])


def vacuum(spark: SparkSession, path: str) -> list[str]:
    """Remove bucket files that the current manifest does not name, and the
    manifests before it. Not while an older version is still being read."""
    root = path.rstrip("/")
    version, _, current, _ = _manifest(spark, path)
    gone = []
    for v in children(spark, f"{root}/parts"):
        for b in children(spark, f"{root}/parts/{v}"):
            if b.startswith("bucket=") and current.get(int(b.split("=")[1])) != int(v.split("=")[1]):
                gone.append(f"{root}/parts/{v}/{b}")
    gone += [f"{root}/manifest/version={v}" for v in _versions(spark, path) if v != version]
    for folder in gone:
        remove(spark, folder)
    return gone
