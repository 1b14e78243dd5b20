"""Repeated passages by a blockwise suffix sort over a difference cover.

A byte goes when a string of ``least`` bytes that covers it starts at two
places of the corpus. Such strings are neighbours in the suffix array, so the
suffixes are sorted, one bucket of them at a time, and equal neighbours marked.
Two changes make that a Spark job. Suffixes are ordered by a fingerprint of
their first ``least`` bytes instead of by the bytes: equal beginnings still
come together, which is all that is asked of the array, and a frequent
beginning no longer makes a bucket large. And the difference cover keeps most
suffixes out of the sort: of the offsets below ``least`` two suffixes share
one, at most ``PERIOD - 1`` in, at which both stand on a sample position, so
two that tie for ``least`` bytes have samples there that tie for ``least -
PERIOD + 1`` bytes.

1. *Cover sample.* The sample positions (offset in the document modulo
   ``PERIOD`` in the cover, and the last string of the document) are sorted by
   their next ``least - PERIOD + 1`` bytes. Samples alone in their rank are out.
2. *Long ties of the sample.* Samples that share a rank are sorted by ``least``
   bytes. What tied samples cover goes; inside a long repeat they stand at most
   a period apart, so its inner suffixes need no sort of their own.
3. *Open suffixes.* What is left are suffixes within a period before a ranked
   sample whose string is not covered yet. A sort by short keys finds what else
   could tie with them, and
4. those few are sorted by ``least`` bytes, which decides them.

Every sort is one exchange: a block of documents sends each bucket its keys as
a sorted, delta-coded and compressed set, and gets back one bit a key, and with
it a note to itself of what it learnt a round earlier. Keys of
steps 1 and 3 only narrow the search and are cut to the bits that the corpus
needs; those of 2 and 4 decide and have 96 bits.

Scale: documents are packed where they are read into compressed blocks of
``BLOCK_BYTES`` in a table bucketed by block, so that the texts are moved by no
exchange (a copy of the texts is on disk while the job runs and goes after it). A key counts once
a block, so a passage in a third of all rows is one key of each block; buckets
are even as keys are hashed, and a task holds one, about ``BUCKET_KEYS`` keys
while a block sends at least ``ROW_KEYS`` keys a bucket. Beyond that (some TB
with 4 MB blocks) larger ``block_bytes`` keep the rows full and buckets small.
The driver sees two totals.

Defined cases: a null text is empty; a document under ``least`` bytes loses
nothing; matches never cross documents, rows with one text are two documents;
a null id is kept; repeated rows each give a row; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendstats.llm.common import cut
from trendstats.session import remove, scratch

LEAST = 200
BLOCK_BYTES = 4 << 20
BUCKET_KEYS = 1 << 20
ROW_KEYS = 256
STEP = 1 << 20  # positions worked on at once
STATE = -1  # number of the "bucket" that holds a block's own notes

_MASK = (1 << 64) - 1
_RANDOM = np.random.default_rng(20)
_TABLES = _RANDOM.integers(0, 1 << 63, (2, 256), dtype=np.uint64) * np.uint64(2) + _RANDOM.integers(0, 2, (2, 256)).astype(np.uint64)
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)


def difference_cover(size: int) -> tuple[int, list[int]]:
    """The longest period that ``size`` offsets can cover: every difference
    modulo it is one of two offsets, and only of those (a perfect difference
    set, found by search)."""
    period = size * (size - 1) + 1

    def extend(chosen: list[int], seen: set[int]) -> list[int] | None:
        if len(chosen) == size:
            return chosen
        for x in range(chosen[-1] + 1, period):
            new = [d for c in chosen for d in ((x - c) % period, (c - x) % period)]
            if len(set(new)) == len(new) and not seen.intersection(new):
                found = extend([*chosen, x], seen.union(new))
                if found:
                    return found
        return None

    chosen = extend([0], set())
    if chosen is None:
        raise ValueError(f"no perfect difference set of {size} offsets")
    return period, chosen


PERIOD, COVER = difference_cover(8)


def covers(period: int, cover: list[int]) -> bool:
    return {(a - b) % period for a, b in combinations(cover, 2)} | {(b - a) % period for a, b in combinations(cover, 2)} | {0} == set(range(period))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    if which not in _POWERS or len(_POWERS[which][0]) < n:
        both = []
        for base in (_BASES[which], pow(_BASES[which], -1, 1 << 64)):
            steps = np.full(n, base & _MASK, dtype=np.uint64)
            steps[0] = 1
            both.append(np.cumprod(steps, dtype=np.uint64))
        _POWERS[which] = (both[0], both[1])
    return _POWERS[which]


def _mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of ``x`` (one to one)."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xE9846AF9B1A615D)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xE9846AF9B1A615D)
    return x ^ (x >> np.uint64(28))


def fingerprints(data: np.ndarray, at: np.ndarray, length: int, which: int = 0) -> np.ndarray:
    """64-bit fingerprints of the ``length`` bytes from each of the ascending
    positions ``at``."""
    out = np.empty(len(at), dtype=np.uint64)
    edges = np.searchsorted(at, np.arange(0, len(data) + STEP, STEP))
    powers, inverse = _powers(which, STEP + length + 1)
    for k, (lo, hi) in enumerate(zip(edges[:-1], edges[1:])):
        if lo == hi:
            continue
        part = data[k * STEP : (k + 1) * STEP + length]
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(_TABLES[which][part] * powers[: len(part)], out=sums[1:])
        s = at[lo:hi] - k * STEP
        out[lo:hi] = _mixed((sums[s + length] - sums[s]) * inverse[s])
    return out


# --- sets of keys ------------------------------------------------------------


def _pack(values: np.ndarray) -> bytes:
    """Ascending integers: byte planes of the differences, compressed."""
    steps = np.diff(values, prepend=values.dtype.type(0))
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(steps.view(np.uint8).reshape(len(steps), -1).T).tobytes())


def _unpack(packed: bytes, n: int, dtype=np.uint64) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), dtype=np.uint8).reshape(-1, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view(dtype).ravel(), dtype=dtype)


def _ordered(key: np.ndarray, check: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """An order of the keys, and which of them in that order are new."""
    order = np.argsort(key)
    ordered = key[order]
    new = np.ones(len(key), dtype=bool)
    new[1:] = ordered[1:] != ordered[:-1]
    if check is not None:
        checks = check[order]
        if (~new[1:] & (checks[1:] != checks[:-1])).any():  # one key, two strings
            order = np.lexsort((check, key))
            ordered, checks = key[order], check[order]
            new[1:] = (ordered[1:] != ordered[:-1]) | (checks[1:] != checks[:-1])
    return order, new


class Keys:
    """Keys of a block's positions, as a set in ascending order."""

    def __init__(self, key: np.ndarray, check: np.ndarray | None, asked: np.ndarray | None, bits: int):
        if check is None:
            key = key >> np.uint64(64 - bits)
        order, new = _ordered(key, check)
        starts = np.flatnonzero(new)
        self.key, self.bits = key[order[starts]], bits
        self.check = None if check is None else check[order[starts]]
        self.many = np.diff(np.append(starts, len(key))) > 1
        self.asked = np.ones(len(starts), dtype=bool)
        if asked is not None and len(starts):
            self.asked = np.logical_or.reduceat(asked[order], starts)
        self.place = np.empty(len(key), dtype=np.int64)  # of every position
        self.place[order] = np.cumsum(new) - 1

    def edges(self, buckets: int) -> np.ndarray:
        """Bounds of the buckets, which divide the keys' range evenly."""
        depth = np.uint64(self.bits - (buckets - 1).bit_length())
        return np.searchsorted(self.key, np.arange(buckets + 1, dtype=np.uint64) << depth) if len(self.key) else np.zeros(buckets + 1, dtype=np.int64)

    def rows(self, buckets: int):
        """(bucket, number of keys, packed keys and flags)."""
        edges = self.edges(buckets)
        edges[-1] = len(self.key)
        for b in range(buckets):
            lo, hi = int(edges[b]), int(edges[b + 1])
            if lo < hi:
                flags = np.packbits(np.concatenate((self.many[lo:hi], self.asked[lo:hi])))
                extra = b"" if self.check is None else self.check[lo:hi].tobytes()
                yield b, hi - lo, _pack(self.key[lo:hi]), flags.tobytes() + extra

    def found(self, masks: dict[int, bytes], buckets: int) -> np.ndarray:
        """For every position whether its bit came back set."""
        edges = self.edges(buckets)
        edges[-1] = len(self.key)
        flags = np.zeros(len(self.key), dtype=bool)
        for b, mask in masks.items():
            lo, hi = int(edges[b]), int(edges[b + 1])
            flags[lo:hi] = np.unpackbits(np.frombuffer(mask, dtype=np.uint8), count=hi - lo).astype(bool)
        return flags[self.place]


def _merge(checked: bool):
    """Sorts a bucket; every block gets a bit a key: does the key occur twice
    and did a block ask for it? What a block notes for itself goes back."""

    def answer(rows: list[tuple]) -> Iterator[tuple]:
        keys = [_unpack(keys, n) for _, n, keys, _ in rows]
        flags = [np.unpackbits(np.frombuffer(f, dtype=np.uint8)[: -(-2 * n // 8)], count=2 * n).astype(bool) for _, n, _, f in rows]
        key = np.concatenate(keys)
        many, asked = (np.concatenate([f[h * n : h * n + n] for f, (_, n, _, _) in zip(flags, rows)]) for h in (0, 1))
        check = np.concatenate([np.frombuffer(f, dtype=np.uint32, offset=-(-2 * n // 8)) for _, n, _, f in rows]) if checked else None
        order, new = _ordered(key, check)
        starts = np.flatnonzero(new)
        twice = (np.diff(np.append(starts, len(key))) > 1) | np.logical_or.reduceat(many[order], starts)
        result = np.empty(len(key), dtype=bool)
        result[order] = (twice & np.logical_or.reduceat(asked[order], starts))[np.cumsum(new) - 1]
        at = 0
        for block, n, _, _ in rows:
            if result[at : at + n].any():
                yield block, np.packbits(result[at : at + n]).tobytes()
            at += n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held = None, []

        def out():
            found = [(b, flags) for b, _, _, flags in held] if bucket < 0 else list(answer(held))
            return pa.RecordBatch.from_arrays(
                [pa.array([b for b, _ in found], pa.int64()), pa.array([max(bucket, STATE)] * len(found), pa.int64()), pa.array([m for _, m in found], pa.binary())],
                names=["block", "bucket", "mask"],
            )

        for batch in batches:
            for b, block, n, keys, flags in zip(*(batch.column(c).to_pylist() for c in ("bucket", "block", "n", "keys", "flags"))):
                if b != bucket and held:
                    yield out()
                    held = []
                bucket = b
                held.append((block, n, keys, flags))
        if held:
            yield out()

    return run


# --- blocks ------------------------------------------------------------------

_BLOCK = "block long, ids array<long>, sizes array<long>, data binary"


def _blocks(block_bytes: int):
    """Documents in the order they are read, packed into blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1)
        ids, texts, size, at = [], [], 0, None

        def out():
            data = b"".join(texts)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([at], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
                    pa.array([[len(t) for t in texts]], pa.list_(pa.int64())), pa.array([squeeze.compress(data)], pa.binary()),
                ],
                names=["block", "ids", "sizes", "data"],
            )

        for batch in batches:
            for row, i, text in zip(*(batch.column(c) for c in ("rid", "id", "text"))):
                text = text.as_py() or b""
                if texts and size + len(text) > block_bytes:
                    yield out()
                    ids, texts, size = [], [], 0
                if not texts:
                    at = row.as_py()
                ids.append(i.as_py())
                texts.append(text)
                size += len(text)
        if texts:
            yield out()

    return run


class _Steps:
    """What the rounds so far say about one block."""

    def __init__(self, ids: list, sizes: list[int], packed: bytes, least: int, bits: tuple[int, int]):
        self.least, self.bits, self.ids = least, bits, ids
        self.data = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed, max_output_size=max(1, sum(sizes))) if sum(sizes) else b"", dtype=np.uint8)
        self.starts = np.concatenate(([0], np.cumsum(np.array(sizes, dtype=np.int64))))
        n = len(self.data)
        room = np.repeat(self.starts[1:], sizes) - np.arange(n)  # bytes to the end of the document
        local = np.arange(n) - np.repeat(self.starts[:-1], sizes)
        on = np.isin(np.arange(PERIOD), COVER)[local % PERIOD] & (room >= least - PERIOD + 1) & (local + room >= least)
        on |= room == least
        self.whole, self.on = room >= least, np.flatnonzero(on)
        self.ranked, self.covered = self.on[:0], np.zeros(n, dtype=bool)
        self.open = self.tied = self.asked = self.tied_asked = None

    def _cover(self, at: np.ndarray) -> None:
        turns = np.zeros(len(self.data) + 1, dtype=np.int32)
        turns[at] += 1
        turns[at + self.least] -= 1
        self.covered |= np.cumsum(turns)[:-1] > 0

    def at(self, step: int) -> np.ndarray:
        """The positions that a round is about."""
        return (self.on, self.ranked, self.open, self.tied)[step]

    def keys(self, step: int) -> Keys:
        """The keys that the block sends in a round."""
        at, asked = self.at(step), (None, None, self.asked, self.tied_asked)[step]
        if step == 0:
            return Keys(fingerprints(self.data, at, self.least - PERIOD + 1), None, None, self.bits[0])
        key = fingerprints(self.data, at, self.least)
        if step == 2:
            return Keys(key, None, asked, self.bits[1])
        return Keys(key, (fingerprints(self.data, at, self.least, 1) >> np.uint64(32)).astype(np.uint32), asked, 64)

    def take(self, step: int, found: np.ndarray) -> None:
        """The answers of a round."""
        if step == 0:
            ranks = self.on[found]
            self.ranked = ranks[self.whole[ranks]]
            near = np.zeros(len(self.data) + 1, dtype=np.int32)  # suffixes that reach a ranked sample
            near[0] = np.count_nonzero(ranks < PERIOD)
            near[ranks[ranks >= PERIOD] - PERIOD + 1] += 1
            near[ranks + 1] -= 1
            self.reach = np.flatnonzero((np.cumsum(near)[:-1] > 0) & self.whole)
        elif step == 1:
            self._cover(self.ranked[found])
            bare = np.concatenate(([0], np.cumsum(~self.covered)))
            self.open = self.reach
            self.asked = bare[self.open + self.least] > bare[self.open]
        elif step == 2:
            self.tied, self.tied_asked = self.open[found], self.asked[found]
        else:
            self._cover(self.tied[found & self.tied_asked])

    def result(self) -> Iterator[tuple]:
        """Per document: id, bytes, spans that go, bytes that stay."""
        for i, lo, hi in zip(self.ids, self.starts[:-1].tolist(), self.starts[1:].tolist()):
            gone = self.covered[lo:hi]
            turns = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False])).astype(np.int8)))
            spans = [{"start": int(a), "end": int(b)} for a, b in zip(turns[::2], turns[1::2])]
            yield i, hi - lo, spans, self.data[lo:hi][~gone].tobytes()


def _steps(row: dict, rounds: int, least: int, bits: tuple[int, int], buckets: int) -> tuple[_Steps, np.ndarray | None]:
    """A block after ``rounds`` rounds, and the last one's answers: those of
    the rounds before are in the block's notes."""
    state, found = _Steps(row["ids"], row["sizes"], row["data"], least, bits), None
    for step in range(rounds):
        if step < rounds - 1:
            note = next(m["mask"] for m in row[f"masks{step + 1}"] if m["bucket"] == STATE)
            packed = np.frombuffer(zstandard.ZstdDecompressor().decompress(note), dtype=np.uint8)
            found = np.unpackbits(packed, count=len(state.at(step))).astype(bool)
        else:
            masks = {m["bucket"]: m["mask"] for m in row[f"masks{step}"] or () if m["bucket"] != STATE}
            found = state.keys(step).found(masks, buckets)
        state.take(step, found)
    return state, found


def _send(step: int, least: int, bits: tuple[int, int], buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                state, found = _steps(row, step, least, bits, buckets)
                sent = list(state.keys(step).rows(buckets))
                if found is not None:
                    sent.append((STATE - row["block"] % (1 << 40), 0, b"", squeeze.compress(np.packbits(found).tobytes())))
                b, n, keys, flags = zip(*sent) if sent else ((), (), (), ())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(b, pa.int64()), pa.array([row["block"]] * len(b), pa.int64()), pa.array(n, pa.int64()), pa.array(keys, pa.binary()), pa.array(flags, pa.binary())],
                    names=["bucket", "block", "n", "keys", "flags"],
                )

    return run


_RESULT = "id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary"


def _results(least: int, bits: tuple[int, int], buckets: int):
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                found = list(zip(*_steps(batch.slice(k, 1).to_pylist()[0], 4, least, bits, buckets)[0].result()))
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(found, kinds)], names=["id", "n_bytes", "spans", "kept"])

    return run


def _bits(total: int, spare_bits: int) -> int:
    return min(64, max(16, (max(total, 1) - 1).bit_length() + spare_bits))


def without_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, block_bytes: int = BLOCK_BYTES,
    bucket_keys: int = BUCKET_KEYS, derive: Callable[[DataFrame], DataFrame] = lambda found: found,
) -> DataFrame:
    """Per row of ``docs``: ``id``, ``n_bytes``, ``spans`` (byte ranges that
    go, in order) and ``kept`` (the bytes that stay). ``derive`` is applied to
    that before it is written to the shared folder, for callers who want less
    than all bytes there."""
    if least < PERIOD:
        raise ValueError(f"strings of at least {PERIOD} bytes are found, not of {least}")
    spark = docs.sparkSession
    texts = docs.select(
        F.monotonically_increasing_id().alias("rid"), F.col(id_col).cast("long").alias("id"),
        F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"),
    )
    total = texts.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
    bits = (_bits(total, 6), _bits(total, 2))
    share = len(COVER) / PERIOD
    most = max(1, int(block_bytes * share) // ROW_KEYS)
    buckets = 1 << min(most.bit_length() - 1, max(0, (int(total * share) // bucket_keys).bit_length()))
    lanes = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // (4 * block_bytes)))

    folder = scratch(spark, "blocks")
    name = "blocks_" + folder.rsplit("-", 1)[-1]
    texts.mapInArrow(_blocks(block_bytes), _BLOCK).write.option("path", folder).bucketBy(lanes, "block").saveAsTable(name)
    blocks = spark.table(name)
    for step in range(4):
        sent = blocks.mapInArrow(_send(step, least, bits, buckets), "bucket long, block long, n long, keys binary, flags binary")
        answered = sent.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_merge(step % 2 == 1), "block long, bucket long, mask binary")
        masks = cut(answered.groupBy("block").agg(F.collect_list(F.struct("bucket", "mask")).alias(f"masks{step}")))
        blocks = blocks.join(masks, "block", "left")
    found = cut(derive(blocks.mapInArrow(_results(least, bits, buckets), _RESULT)))
    spark.sql(f"DROP TABLE {name}")
    remove(spark, folder)
    return found
