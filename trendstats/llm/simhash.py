"""SimHash near-duplicates with bit-sliced comparison.

Fingerprint: 64-bit majority vote over the XXH64 values (seed 42) of word
shingles. Two fingerprints within ``radius`` differing bits agree on one of
``radius + 1`` blocks, and on one of as many pieces of the remaining bits;
each (block, piece) pair is a bucket table, so every linked pair meets in a
bucket. Inside a bucket the fingerprints are stored as vertical bit planes
(one machine word holds one bit of 64 documents). A block of queries is
XORed plane by plane and carry-save counters add the differing bits of all
lanes at once; a block is abandoned once every lane exceeds the radius.

Scale: exact copies collapse to one fingerprint before any bucket is built;
a fingerprint makes (radius+1)^2 slim rows; buckets of one are dropped after
a pre-aggregated count. A bucket over ``bucket_rows`` is dealt out as pairs
of hash chunks, each pair its own task unit (all pairs of chunks are
compared, so nothing is lost). A bucket emits only links that join two
classes not yet joined there, at most its rows.

Defined cases: a null or empty text, or one without words, has fingerprint
zero and is linked like any other; texts with fewer words than the shingle
are one shingle; repeated rows each get a result row; a null ``doc_id`` is
kept and never is a component's id unless all ids of the component are
null; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendstats.llm.common import cut, spare
from trendstats.llm.graph import connected_components

BITS = 64
LANES = 64  # queries per block, and lanes per machine word
_STEP = 1 << 16  # shingles voted at once


def fingerprint_of(text: bytes | None, shingle: int = 3) -> int:
    """Unsigned fingerprint of a UTF-8 text. ``bytes.lower`` changes A-Z
    only; ``bytes.split`` splits at space and 0x09-0x0D."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = [b" ".join(g) for g in zip(*(words[i:] for i in range(shingle)))]
    hashes = np.fromiter((xxhash.xxh64_intdigest(g, 42) for g in grams), dtype="<u8", count=len(grams))
    votes = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), _STEP):
        part = hashes[at : at + _STEP].view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (votes * 2 > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprint(text: Column, shingle: int = 3) -> Column:
    """Fingerprint column (the 64 bits as a signed long)."""

    @F.pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            values = np.fromiter((fingerprint_of(t, shingle) for t in texts), dtype=np.uint64, count=len(texts))
            yield pd.Series(values.view(np.int64))

    return of(text.cast("binary"))


def hex_of(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


# --- bit-sliced comparison ---------------------------------------------------


def bit_planes(values: np.ndarray) -> np.ndarray:
    """(64, words) array: bit p of value i is bit i of row p."""
    lanes = -(-len(values) // LANES) * LANES
    padded = np.zeros(lanes, dtype="<u8")
    padded[: len(values)] = values
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view("<u8")


def within(queries: np.ndarray, planes: np.ndarray, radius: int) -> np.ndarray | None:
    """(queries, words) lane masks of the targets at most ``radius`` bits
    away; None when the block was abandoned."""
    size = max(1, radius.bit_length())
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    counters = [np.zeros((len(queries), planes.shape[1]), dtype=np.uint64) for _ in range(size)]
    over = np.zeros_like(counters[0])
    for p in range(BITS):
        flip = np.where((queries >> np.uint64(p)) & np.uint64(1), full, np.uint64(0))
        carry = planes[p][None, :] ^ flip[:, None]
        for k in range(size):
            carry, counters[k] = counters[k] & carry, counters[k] ^ carry
        over |= carry
        if p % 8 == 7 and (over == full).all():
            return None
    # lanes whose counter exceeds the radius, most significant bit first
    above, equal = np.zeros_like(over), np.full_like(over, full)
    for k in reversed(range(size)):
        if radius >> k & 1:
            equal &= counters[k]
        else:
            above |= equal & counters[k]
            equal &= ~counters[k]
    return ~(over | above)


def links_in(values: np.ndarray, split: int, radius: int, bounds: np.ndarray) -> list[tuple[int, int]]:
    """Links between sorted groups of ``values`` that join classes not yet
    joined. ``bounds[i]`` is the end of the group of row i; with ``split`` > 0
    only rows before it are queries and only rows from it on are targets."""
    labels = np.arange(len(values))
    found: list[tuple[int, int]] = []
    last = split or len(values)
    for at in range(0, last, LANES):
        end = min(at + LANES, last)
        start, stop = (split, len(values)) if split else (at, int(bounds[end - 1]))
        if stop - start < 1 or (not split and stop - at < 2):
            continue
        masks = within(values[at:end], bit_planes(values[start:stop]), radius)
        if masks is None:
            continue
        hits = np.unpackbits(np.ascontiguousarray(masks).view(np.uint8), axis=1, bitorder="little")[:, : stop - start]
        for q in np.flatnonzero(hits.any(axis=1)):
            row = at + int(q)
            near = np.flatnonzero(hits[q]) + start
            near = near[(near > row) & (near < bounds[row])]
            fresh = near[labels[near] != labels[row]]
            while len(fresh):
                other = int(fresh[0])
                found.append((row, other))
                labels[labels == labels[other]] = labels[row]
                fresh = fresh[labels[fresh] != labels[row]]
    return found


def _compare(radius: int):
    names = ("bucket", "i", "j", "r", "fp")

    def links(cols: dict[str, np.ndarray]) -> tuple[list, list]:
        a, b = [], []
        fp = cols["fp"].view(np.uint64)
        same = (np.diff(cols["bucket"]) == 0) & (np.diff(cols["i"]) == 0) & (np.diff(cols["j"]) == 0)
        edges = np.concatenate(([0], np.flatnonzero(~same) + 1, [len(fp)]))
        within_one = cols["i"] == cols["j"]
        # groups compared with themselves go together, block by block
        own = np.flatnonzero(within_one)
        if len(own):
            ends = edges[np.searchsorted(edges, own, side="right")]
            bounds = np.searchsorted(own, ends, side="left")
            for x, y in links_in(fp[own], 0, radius, bounds):
                a.append(fp[own[x]])
                b.append(fp[own[y]])
        for lo, hi in zip(edges[:-1], edges[1:]):
            if not within_one[lo]:  # chunk i against chunk j
                split = int((cols["r"][lo:hi] == cols["i"][lo]).sum())
                if 0 < split < hi - lo:
                    for x, y in links_in(fp[lo:hi], split, radius, np.full(hi - lo, hi - lo)):
                        a.append(fp[lo + x])
                        b.append(fp[lo + y])
        return a, b

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {n: np.empty(0, dtype=np.int64) for n in names}

        def out(cols):
            a, b = links(cols)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.array(x, dtype=np.uint64).view(np.int64), pa.int64()) for x in (a, b)], names=["a", "b"]
            )

        for batch in batches:
            held = {n: np.concatenate((held[n], batch.column(n).to_numpy(zero_copy_only=False))) for n in names}
            # keep the last group: the next batch may go on with it
            tail = np.ones(len(held["fp"]), dtype=bool)
            for n in ("bucket", "i", "j"):
                tail &= held[n] == held[n][-1] if len(tail) else tail
            first = int(np.argmax(tail)) if len(tail) else 0
            if first:
                yield out({n: v[:first] for n, v in held.items()})
                held = {n: v[first:] for n, v in held.items()}
        if len(held["fp"]):
            yield out(held)

    return run


def _bucket_keys(fp: Column, radius: int) -> list[Column]:
    """One long per (block, piece): table number and the agreeing bits."""
    n = radius + 1
    cuts = [BITS * k // n for k in range(n + 1)]
    keys = []
    for t, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
        width = hi - lo
        block = F.shiftrightunsigned(fp, lo).bitwiseAND(F.lit((1 << width) - 1)) if width < BITS else fp
        rest_bits = BITS - width
        low = fp.bitwiseAND(F.lit((1 << lo) - 1))
        rest = low if hi == BITS else low.bitwiseOR(F.shiftleft(F.shiftrightunsigned(fp, hi), lo))
        parts = [rest_bits * k // n for k in range(n + 1)]
        if rest_bits == 0:
            keys.append(F.xxhash64(F.lit(t), block))
            continue
        for u, (a, b) in enumerate(zip(parts, parts[1:])):
            piece = F.shiftrightunsigned(rest, a).bitwiseAND(F.lit((1 << (b - a)) - 1))
            keys.append(F.xxhash64(F.lit(t * n + u), block, piece))
    return keys


def links(fps: DataFrame, radius: int = 3, bucket_rows: int = 4096) -> DataFrame:
    """Links ``(a, b)`` that connect the distinct fingerprints ``fp`` within
    ``radius`` bits (enough of them to span every class)."""
    keyed = fps.select(F.explode(F.array(*_bucket_keys(F.col("fp"), radius))).alias("bucket"), "fp")
    sizes = keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    chunks = F.ceil(F.col("n") / F.lit(bucket_rows))
    met = keyed.join(sizes, "bucket").select("bucket", "fp", chunks.alias("c")).select(
        "bucket", "fp", "c", F.pmod(F.xxhash64("fp", F.lit(7)), F.col("c")).alias("r")
    )
    dealt = met.select("bucket", "fp", "r", F.explode(F.sequence(F.lit(0).cast("long"), F.col("c") - 1)).alias("x"))
    dealt = dealt.select("bucket", F.least("r", "x").alias("i"), F.greatest("r", "x").alias("j"), "r", "fp")
    ready = dealt.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "r", "fp")
    return ready.mapInArrow(_compare(radius), "a long, b long")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 3
) -> DataFrame:
    """One row per input row: ``doc_id``, ``text_key`` (hash of the text),
    ``fingerprint`` (hex), ``component`` (a fingerprint of the class) and
    ``component_id`` (smallest id of the class)."""
    slim = cut(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.xxhash64(F.col(text_col)).alias("text_key"),
            fingerprint(F.col(text_col), shingle).alias("fp"),
        )
    )
    fps = cut(slim.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    comps = connected_components(links(fps.select("fp"), radius)).withColumnRenamed("node", "fp")
    members = fps.join(comps, "fp", "left").select("fp", "first_id", F.coalesce("component", "fp").alias("component"))
    ids = members.groupBy("component").agg(F.min("first_id").alias("component_id"))
    members = members.select("fp", "component").join(ids, "component")
    return slim.join(members, "fp").select(
        "doc_id", "text_key", hex_of(F.col("fp")).alias("fingerprint"), "component", "component_id"
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 3) -> DataFrame:
    """``docs`` with one row of every near-duplicate class: the one with the
    smallest id (ties: smallest text hash; equal rows: any one of them)."""
    found = near_duplicates(docs, id_col, text_col, shingle, radius)
    first = found.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    first = first.groupBy("component", "doc_id", "text_key").agg(F.count(F.lit(1)).alias("n"))
    kept = cut(
        first.groupBy("component").agg(F.min(F.struct("text_key", "n")).alias("k"), F.min("doc_id").alias("__id"))
        .select("__id", F.col("k.text_key").alias("__key"), F.col("k.n").alias("__n"))
    )
    key = spare(docs, "__text_key")
    rows = docs.withColumn(key, F.xxhash64(F.col(text_col)))
    rows = rows.join(kept, rows[id_col].eqNullSafe(kept["__id"]) & (rows[key] == kept["__key"]), "left_semi")
    if kept.where("__n > 1").limit(1).count():  # equal rows, of which one stays
        rows = rows.dropDuplicates([id_col, key])
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])
