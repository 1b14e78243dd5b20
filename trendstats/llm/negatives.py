"""Hard negatives by slot-decomposed selection.

Every anchor has up to ``positives`` positives: the other rows of its label
with the highest scores (ties: smaller id). A positive's window holds the rows
of other labels that score at most as high as it and at least
``ratio[0] / ratio[1]`` of that; the first ``negatives`` of a window are
returned. An anchor's windows overlap, but their upper limits, put in order,
cut its scores into disjoint slots. Each task keeps the first ``negatives``
rows of every slot, a merge keeps as many of all tasks, and the windows are
read off the slots: the slots from a positive's own one down, in descending
order, hold the first ``negatives`` rows not above its limit, so one sorted
run of at most ``positives * negatives`` rows answers all of an anchor's
windows.

Scores are exact integers: components become ``floor(scale * x)`` as doubles,
products go through one matrix product while every partial sum stays below
2^53 and through whole-number arithmetic otherwise; a score that a long cannot
hold counts as the nearest long but the smallest.

Scale: rows are dealt evenly into parts of ``PART_BYTES`` of vectors (by row
number, so no id or label makes a part large); a part is one matrix in a task,
and the anchors, a stated query set, stream past it in blocks. What is shuffled
is the rows once, the anchors once a part, and per anchor and part at most
``positives * negatives`` numbers. No vector is broadcast or collected.

Defined cases: rows with a null label, a null vector or a null or non-finite
component take no part; vectors of unequal length count as padded with zeros
(an empty one scores 0); a null id is no anchor and comes last among ties; a
row with the anchor's id is not "another row", repeated rows each count; an
anchor without positives, and a positive without a row in its window (always
so below a score of 0), gives no row; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendstats.llm.common import cut

PART_BYTES = 64 << 20  # vectors of one part, as doubles
PART_LEAST = 2048  # rows a part has at least where cores would lie idle
BLOCK_BYTES = 32 << 20  # scores of one block of anchors
EXACT = float(1 << 53)
LONG = (1 << 63) - 1

_IN = "part long, tag int, id long, label string, vec array<double>, aid long, limits array<long>"
_OUT = "aid long, slot int, score long, id long"


def finite(vec: Column) -> Column:
    """No null, NaN or infinite component (and no null vector)."""
    whole = F.forall(vec, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))), F.lit(False)))
    return F.coalesce(whole, F.lit(False))


def matrix(vectors: pa.Array) -> np.ndarray:
    """List column as a matrix of doubles, short rows padded with zeros."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    lengths = np.diff(vectors.offsets.to_numpy())
    width = int(lengths.max(initial=0))
    if (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width))
    out[np.arange(width)[None, :] < lengths[:, None]] = flat
    return out


def _whole(x: float, scale: int) -> int:
    scaled = x * scale
    return math.floor(scaled) if math.isfinite(scaled) else int(x) * scale


def scores(a: np.ndarray, b: np.ndarray, scale: int) -> np.ndarray:
    """Integer inner products (rows of ``a`` by rows of ``b``)."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), dtype=np.int64)
    with np.errstate(over="ignore"):
        fa, fb = np.floor(a * scale), np.floor(b * scale)
        small = np.abs(fa).max() * np.abs(fb).max() * width < EXACT
    if small:
        return (fa @ fb.T).astype(np.int64)
    ia = [[_whole(x, scale) for x in row] for row in a.tolist()]
    ib = [[_whole(x, scale) for x in row] for row in b.tolist()]
    rows = [[max(-LONG, min(LONG, sum(x * y for x, y in zip(p, q)))) for q in ib] for p in ia]
    return np.array(rows, dtype=np.int64)


def first(values: np.ndarray, ties: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """Of the positions ``at``, the ``k`` with the highest values (ties: the
    smallest ``ties``), in that order."""
    if len(at) > 4 * k:
        found = values[at]
        at = at[found >= np.partition(found, len(at) - k)[len(at) - k]]
    return at[np.lexsort((ties[at], -values[at]))][:k]


class _Part:
    """The rows of one part, in label order."""

    def __init__(self, batches: list[pa.RecordBatch]):
        table = pa.Table.from_batches(batches)
        ids, labels = table.column("id"), table.column("label").to_numpy().astype(str)
        known = ids.fill_null(LONG).to_numpy()
        order = np.lexsort((known, labels))
        self.ids, self.null = known[order], ids.is_null().to_numpy()[order]
        self.labels, self.vecs = labels[order], matrix(table.column("vec").combine_chunks())[order]
        self.ties = np.empty(len(order), dtype=np.int64)
        self.ties[np.lexsort((self.null, self.ids))] = np.arange(len(order))

    def same(self, label: str) -> tuple[int, int]:
        return int(np.searchsorted(self.labels, label, "left")), int(np.searchsorted(self.labels, label, "right"))

    def near(self, anchors: pa.Table, scale: int, k: int):
        """Per anchor the first ``k`` other rows of its label."""
        vecs, labels = matrix(anchors.column("vec").combine_chunks()), anchors.column("label").to_pylist()
        own = anchors.column("id").to_pylist()
        for label in dict.fromkeys(labels):
            lo, hi = self.same(label)
            rows = [i for i, x in enumerate(labels) if x == label]
            if lo == hi:
                continue
            found = scores(vecs[rows], self.vecs[lo:hi], scale)
            for i, values in zip(rows, found):
                other = np.flatnonzero((self.ids[lo:hi] != own[i]) | self.null[lo:hi])
                top = first(values, self.ties[lo:hi], other, k)
                yield i, np.zeros(len(top), dtype=np.int32), values[top], lo + top

    def slots(self, anchors: pa.Table, scale: int, k: int, ratio: tuple[int, int]):
        """Per anchor the first ``k`` rows of other labels of every slot."""
        found = scores(matrix(anchors.column("vec").combine_chunks()), self.vecs, scale)
        for i, (values, label, limits) in enumerate(
            zip(found, anchors.column("label").to_pylist(), anchors.column("limits").to_pylist())
        ):
            least = -(-ratio[0] * limits[0] // ratio[1])  # of the lowest window
            lo, hi = self.same(label)
            fits = (values >= least) & (values <= limits[-1])
            fits[lo:hi] = False
            at = np.flatnonzero(fits)
            slot = np.searchsorted(np.array(limits, dtype=np.int64), values[at], "left")
            for s in range(len(limits)):
                top = first(values, self.ties, at[slot == s], k)
                yield i, np.full(len(top), s, dtype=np.int32), values[top], top


def _scan(select):
    """Streams parts: the rows of a part first, then its anchors."""

    def out(part: _Part, anchors: pa.Table) -> pa.RecordBatch:
        aids = anchors.column("aid").to_numpy()
        none = np.empty(0, dtype=np.int64)
        found = [(np.full(len(at), aids[i]), slot, value, at) for i, slot, value, at in select(part, anchors)]
        aid, slot, value, at = (np.concatenate(x) if found else none for x in (zip(*found) if found else ((),) * 4))
        ids = pa.array(part.ids[at], pa.int64(), mask=part.null[at])
        return pa.RecordBatch.from_arrays(
            [pa.array(aid, pa.int64()), pa.array(slot, pa.int32()), pa.array(value, pa.int64()), ids],
            names=["aid", "slot", "score", "id"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, part, waiting, n = None, [], None, [], 0

        def flush():
            nonlocal waiting, n
            if waiting and part is not None:
                table = pa.Table.from_batches(waiting)
                step = max(1, BLOCK_BYTES // (8 * len(part.ids)))
                for lo in range(0, table.num_rows, step):
                    yield out(part, table.slice(lo, step))
            waiting, n = [], 0

        for batch in batches:
            keys = batch.column("part").to_numpy() * 2 + batch.column("tag").to_numpy()
            edges = np.concatenate(([0], np.flatnonzero(np.diff(keys)) + 1, [len(keys)]))
            for lo, hi in zip(edges[:-1], edges[1:]):
                if lo == hi:
                    continue
                this, piece = int(keys[lo]), batch.slice(lo, hi - lo)
                if this // 2 != number:
                    yield from flush()
                    number, held, part = this // 2, [], None
                if this % 2 == 0:
                    held.append(piece)
                    continue
                if part is None and held:
                    part, held = _Part(held), []
                waiting.append(piece)
                n += hi - lo
                if part is not None and n * len(part.ids) * 8 >= BLOCK_BYTES:
                    yield from flush()
        yield from flush()

    return run


def _pass(rows: DataFrame, anchors: DataFrame, parts: int, select) -> DataFrame:
    """``select`` over every (part of the rows, block of anchors)."""
    dealt = rows.select(
        F.pmod(F.monotonically_increasing_id(), F.lit(parts)).alias("part"), F.lit(0).alias("tag"), "id", "label", "vec",
        F.lit(None).cast("long").alias("aid"), F.lit(None).cast("array<long>").alias("limits"),
    )
    asked = anchors.select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("part"), F.lit(1).alias("tag"),
        "id", "label", "vec", "aid", "limits",
    )
    ready = dealt.union(asked).repartition(parts, "part").sortWithinPartitions("part", "tag")
    return ready.mapInArrow(_scan(select), _OUT)


def _best(found: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k)


def mine(
    vectors: DataFrame,
    anchor: Column,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label: Column | str = "label",
    positives: int = 5,
    negatives: int = 5,
    ratio: tuple[int, int] = (80, 100),
    scale: int = 256,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``,
    ``positive_score``, ``negative_score`` for the rows where ``anchor`` is
    true; ``label`` may be any expression over the table."""
    label = F.col(label) if isinstance(label, str) else label
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), label.cast("string").alias("label"),
        F.col(vec_col).cast("array<double>").alias("vec"), F.coalesce(anchor, F.lit(False)).alias("anchor"),
    ).where(F.col("label").isNotNull() & finite(F.col("vec")))
    total, width = rows.agg(F.count(F.lit(1)), F.max(F.size("vec"))).first()
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    parts = max(1, -(-total * max(width or 1, 1) * 8 // PART_BYTES), min(cores, -(-total // PART_LEAST)))

    asked = rows.where("anchor and id is not null").select(F.monotonically_increasing_id().alias("aid"), "id", "label", "vec")
    anchors = cut(asked.withColumn("limits", F.lit(None).cast("array<long>")))
    near = _pass(rows, anchors, parts, lambda part, block: part.near(block, scale, positives))
    near = cut(_best(near, ["aid"], positives).select("aid", F.col("n").alias("at"), F.col("score").alias("limit"), F.col("id").alias("pid")))

    limits = near.groupBy("aid").agg(F.sort_array(F.collect_set("limit")).alias("limits"))
    limited = anchors.drop("limits").join(limits, "aid")
    found = _pass(rows, limited, parts, lambda part, block: part.slots(block, scale, negatives, ratio))
    slots = _best(found, ["aid", "slot"], negatives)

    # the slots of an anchor as one run, highest scores first
    run = slots.groupBy("aid").agg(
        F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("o"), F.col("id").isNull().alias("z"), "id", "slot"))).alias("run")
    )
    asked = near.join(limits, "aid").join(run, "aid").join(anchors.select("aid", F.col("id").alias("anchor_id")), "aid")
    own = F.array_position("limits", F.col("limit")) - 1
    exact = lambda c, by: c.cast("decimal(20,0)") * F.lit(by).cast("decimal(10,0)")
    window = F.slice(
        F.filter("run", lambda r: (r["slot"] <= own) & (exact(-r["o"], ratio[1]) >= exact(F.col("limit"), ratio[0]))), 1, negatives
    )
    return asked.select("anchor_id", "pid", "limit", F.posexplode(window).alias("i", "r")).select(
        "anchor_id", F.col("pid").alias("positive_id"), (F.col("i") + 1).cast("int").alias("rank"), F.col("r.id").alias("negative_id"),
        F.col("limit").alias("positive_score"), (-F.col("r.o")).alias("negative_score"),
    )
