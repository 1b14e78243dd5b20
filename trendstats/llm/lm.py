"""Stupid-backoff language-model scores of documents against their corpus.

S(w | v) = c(v w) / c(v) where the bigram table has ``v w``, else
``BACKOFF`` * c(w) / N. Both tables are whole unless ``min_count`` cuts the
bigrams that occur less often. A document starts with a mark, which counts as
a word ``v`` only. The score is the sum of ln S.

The documents are scored by their own corpus, where every bigram occurs at
least once: in the one that is scored. ``leave_out`` takes that occurrence out
(leaving-one-out, Ney et al. 1995): S(w | v) = (c(v w) - 1) / (c(v) - 1) where
``v w`` occurs anywhere else, else the backoff, whose c(w) / N is the word's
left-out count with one added, (c(w) - 1 + 1) / (N - 1 + 1), so that a word
that occurs nowhere else has a finite score.

Tables and joins:

1. The unigram table: partial counts of each task, summed by word hash.
2. The bigrams of all documents, exploded and packed (a row holds those of
   one batch and one hash partition), are dealt by the hash of w. In a
   partition the bigram and unigram counts of its words come from one
   grouping and are joined to the bigrams by it.
3. c(v): where no bigram backs off, every word but a document's last is the
   ``v`` of the word after it, so its own partition subtracts ln c(v). With a
   cut or ``leave_out`` only bigrams that the table has do: from the table of
   known words, or by a join of (v, document, count) with the unigram table.
4. The parts of a document are summed, packed by batch of documents.

Hot keys: a word with at least 1/``HOT`` of all occurrences (there are at
most ``HOT``) is dealt by the hash of the pair instead; a pair of two such
words that has 1/``HOT`` of all occurrences itself (at most ``HOT`` again) is
counted in a pass of its own, with partial counts, and never shuffled. Words
with at least 1/``KNOWN`` of all occurrences (at most ``KNOWN``) are the
broadcast table of known words. These bounds hold for any input; nothing is
dropped or capped.

Words are separated by space and 0x09-0x0D, with A-Z lower-cased; tables use
48-bit word hashes.

Defined cases: null and empty texts have no words and score 0; documents are
told apart by their place in the input, so repeated ids and rows each get a
row and count each; null ids are kept; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendstats.llm.common import cut
from trendstats.session import remove, scratch

BACKOFF = 0.4
MIN_COUNT = 1  # of the bigram table: whole
HOT = 2_000
KNOWN = 1 << 20
ENTRIES = 2_000_000  # bigrams in a hash partition, about
SLICE = 4 << 20  # text bytes that a task works on at once
_MASK = (1 << 48) - 1
START = 0  # hash of the mark before a document
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _slices(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[pa.RecordBatch]:
    """The batches in runs of documents of about ``SLICE`` text bytes."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        at = 0
        while at < batch.num_rows:
            ends = np.cumsum(size[at : at + (1 << 16)])
            n = max(1, int(np.searchsorted(ends, SLICE, side="right")))
            yield batch.slice(at, n)
            at += n


def word_hash(word: bytes) -> int:
    return (xxhash.xxh64_intdigest(word) & _MASK) or 1


def _encoded(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word numbers of all texts in a row, words per text, hash per number."""
    numbers: defaultdict[bytes, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    ids: list[int] = []
    sizes = np.zeros(len(texts), dtype=np.int64)
    for i, text in enumerate(texts):
        words = text.lower().split() if text else []
        sizes[i] = len(words)
        ids += [numbers[w] for w in words]
    hashes = np.fromiter((word_hash(w) for w in numbers), dtype=np.int64, count=len(numbers))
    return np.array(ids, dtype=np.int64), sizes, hashes


def _pairs(ids: np.ndarray, sizes: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of the word before each word, and its text."""
    before = np.empty_like(ids)
    before[1:] = ids[:-1]
    ends = np.cumsum(sizes)
    firsts = (ends - sizes)[sizes > 0]
    before[firsts] = start
    return before, np.repeat(np.arange(len(sizes)), sizes)


def _lookup(keys: np.ndarray, table: np.ndarray, values: np.ndarray, default) -> np.ndarray:
    """Values of ``keys`` in a sorted table."""
    if not len(table):
        return np.full(len(keys), default, dtype=values.dtype)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[at] == keys, values[at], default)


def _unigrams(texts: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, 0):
            ids, sizes, hashes = _encoded(batch.column(0).to_pylist())
            words = np.append(hashes, START)
            counts = np.append(np.bincount(ids, minlength=len(hashes)), (sizes > 0).sum())
            yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(counts.astype(np.int64))], ["h", "c"])

    return texts.mapInArrow(run, "h long, c long").groupBy("h").agg(F.sum("c").alias("c")).where("c > 0")


def _sorted(table: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    got = table.toArrow()
    keys, values = got.column(0).to_numpy(), got.column(1).to_numpy()
    order = np.argsort(keys)
    return keys[order], values[order]


def _hot_pairs(texts: DataFrame, hot, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Codes (place of v * places + place of w among the hot words) and
    counts of the hot pairs."""
    shared = texts.sparkSession.sparkContext.broadcast(hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, 0):
            ids, sizes, hashes = _encoded(batch.column(0).to_pylist())
            codes = _codes(ids, sizes, hashes, shared.value)[0]
            code, n = np.unique(codes[codes >= 0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(n.astype(np.int64))], ["code", "c"])

    counted = texts.mapInArrow(run, "code long, c long").groupBy("code").agg(F.sum("c").alias("c"))
    return _sorted(counted.where(F.col("c") >= F.lit(least)))


def _codes(ids, sizes, hashes, hot):
    places = np.append(_lookup(hashes, hot, np.arange(len(hot)), -1), _lookup(np.array([START]), hot, np.arange(len(hot)), -1))
    before, doc = _pairs(ids, sizes, len(hashes))
    v, w = places[before], places[ids]
    return np.where((v >= 0) & (w >= 0), v * len(hot) + w, -1), before, doc, w


_PACKED = ("p", "base", "w", "n", "low", "high", "doc", "last", "ids", "nulls", "sizes", "score", "seen")


def _packed(shared, parts: int, min_count: int, starts: int, less: int):
    """Exploded bigrams of a batch, a row per hash partition, and a row of
    its documents with the score of their hot pairs."""
    schema = pa.schema([(n, pa.int64() if n in ("p", "base") else pa.binary()) for n in _PACKED])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, known_c, hot, codes, codes_c = shared.value
        for batch in _slices(batches, 2):
            rid = batch.column(0).to_numpy()
            ids, sizes, hashes = _encoded(batch.column(2).to_pylist())
            code, before, doc, w_place = _codes(ids, sizes, hashes, hot)
            hashes = np.append(hashes, START)
            w, v = hashes[ids] if len(ids) else ids, hashes[before] if len(ids) else ids
            pair_c = _lookup(code, codes, codes_c, 0)
            is_hot = pair_c >= max(1, min_count)
            last = np.zeros(len(w), dtype=bool)
            last[(np.cumsum(sizes) - 1)[sizes > 0]] = True
            if min_count > 1:
                minus = np.log(_lookup(v[is_hot], known, known_c, 1) - less)
            else:
                minus = np.where(last[is_hot], 0.0, np.log(_lookup(w[is_hot], known, known_c, 1)))
            score = np.bincount(doc[is_hot], np.log(pair_c[is_hot] - less) - minus, len(sizes)).astype(np.float64)
            if min_count <= 1:  # the mark before the first word
                score -= np.where(sizes > 0, math.log(max(starts, 1)), 0.0)
            seen = np.bincount(doc[is_hot], minlength=len(sizes))
            nulls = np.array([x is None for x in batch.column(1).to_pylist()], dtype=bool)
            doc_ids = np.array([x or 0 for x in batch.column(1).to_pylist()], dtype=np.int64)
            base = int(rid[0])
            assert int(rid[-1]) - base == len(rid) - 1
            rows = [
                (base % parts, base, *[None] * 6, *(x.tobytes() for x in (
                    doc_ids, nulls, sizes, score.astype(np.float64), seen.astype(np.int64))))
            ]
            w, v, doc, last, spread = w[~is_hot], v[~is_hot], doc[~is_hot], last[~is_hot], w_place[~is_hot] >= 0
            mixed = (w.view(np.uint64) * _MIX) ^ np.where(spread, v.view(np.uint64) * _MIX * _MIX, np.uint64(0))
            part = ((mixed >> np.uint64(20)) % np.uint64(parts)).astype(np.int64)
            order = np.lexsort((w, part))
            w, v, doc, last, part = w[order], v[order], doc[order], last[order], part[order]
            ends = np.flatnonzero(np.diff(part, append=-1)) + 1 if len(part) else []
            lo = 0
            for hi in ends:
                words, n = np.unique(w[lo:hi], return_counts=True)
                rows.append((int(part[lo]), base, *(x.tobytes() for x in (
                    words, n.astype(np.int32), (v[lo:hi] & 0xFFFFFFFF).astype(np.uint32),
                    (v[lo:hi] >> 32).astype(np.uint16), doc[lo:hi].astype(np.uint16), np.packbits(last[lo:hi]))), *[None] * 5))
                lo = hi
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, schema.field(i).type) for i, column in enumerate(zip(*rows))], schema=schema
            )

    return run, ", ".join(f"{n} {'long' if n in ('p', 'base') else 'binary'}" for n in _PACKED)


_PARTS = {
    "base": pa.int64(), "doc": pa.binary(), "score": pa.binary(), "seen": pa.binary(),
    "ids": pa.binary(), "nulls": pa.binary(), "sizes": pa.binary(), "rid": pa.int64(), "v": pa.int64(), "n": pa.int64(),
}
_DOCS = {"rid": pa.int64(), "doc_id": pa.int64(), "n_words": pa.int64(), "seen": pa.int64(), "score": pa.float64()}


def _ddl(kinds: dict[str, pa.DataType]) -> str:
    names = {pa.int64(): "long", pa.float64(): "double", pa.binary(): "binary"}
    return ", ".join(f"{n} {names[t]}" for n, t in kinds.items())


def _joined(shared, total: int, min_count: int, less: int):
    """Counts of a hash partition joined to its bigrams. Out come, packed by
    batch of documents, the parts of their scores, and a row for each (v,
    document) whose c(v) is still to be joined."""

    def rows(**columns) -> pa.Table:
        size = len(next(iter(columns.values())))
        return pa.table({n: pa.array(columns[n], t) if n in columns else pa.nulls(size, t) for n, t in _PARTS.items()})

    def run(table: pa.Table) -> pa.Table:
        known, known_c = shared.value[:2]
        out, bases, w, v, doc, last = [], [], [], [], [], []
        for row in table.select([n for n in _PACKED if n != "p"]).to_pylist():
            if row["ids"] is not None:
                out.append(rows(**{n: [row[n]] for n in ("base", "ids", "nulls", "sizes", "score", "seen")}))
            else:
                words = np.frombuffer(row["w"], dtype=np.int64)
                w.append(np.repeat(words, np.frombuffer(row["n"], dtype=np.int32)))
                high = np.frombuffer(row["high"], dtype=np.uint16).astype(np.int64)
                v.append(high << 32 | np.frombuffer(row["low"], dtype=np.uint32).astype(np.int64))
                doc.append(np.frombuffer(row["doc"], dtype=np.uint16))
                last.append(np.unpackbits(np.frombuffer(row["last"], dtype=np.uint8), count=len(doc[-1])).astype(bool))
                bases.append(row["base"])
        if w:
            ends = np.cumsum([len(x) for x in w])
            w, v, docs = np.concatenate(w), np.concatenate(v), np.concatenate(doc)
            _, back, n = np.unique(w, return_inverse=True, return_counts=True)
            # a word that is not known has all its occurrences here
            word_c = _lookup(w, known, known_c, 0)
            word_c = np.where(word_c > 0, word_c, n[back])
            key = w.view(np.uint64) * _MIX + v.view(np.uint64)
            _, back, n = np.unique(key, return_inverse=True, return_counts=True)
            pair_c = n[back]
            has = pair_c >= min_count
            if min_count > 1:
                before_c = _lookup(v, known, known_c, 0)
                gain = np.where(
                    has, np.log(np.maximum(pair_c - less, 1)) - np.log(np.maximum(before_c - less, 1)),
                    math.log(BACKOFF) + np.log(word_c) - math.log(total),
                )
            else:
                gain = np.log(pair_c) - np.where(np.concatenate(last), 0.0, np.log(word_c))
            parts = []
            for base, lo, hi in zip(bases, np.append(0, ends[:-1]), ends):
                own, back = np.unique(docs[lo:hi], return_inverse=True)
                seen = np.bincount(back, has[lo:hi]).astype(np.int32)
                parts.append((base, own.tobytes(), np.bincount(back, gain[lo:hi]).tobytes(), seen.tobytes()))
            out.append(rows(**dict(zip(("base", "doc", "score", "seen"), zip(*parts)))))
            open_ = has & (before_c == 0) if min_count > 1 else has[:0]
            if open_.any():
                rid = np.repeat(np.array(bases), np.diff(ends, prepend=0)) + docs
                pairs, n = np.unique(np.stack([v[open_], rid[open_]]), axis=1, return_counts=True)
                out.append(rows(rid=pairs[1], v=pairs[0], n=n.astype(np.int64)))
        return pa.concat_tables(out) if out else rows(rid=[])

    return run


def _summed(table: pa.Table) -> pa.Table:
    """The parts of one batch of documents, added up."""
    parts = table.to_pylist()
    whole = next(row for row in parts if row["ids"] is not None)
    score, seen = np.frombuffer(whole["score"]).copy(), np.frombuffer(whole["seen"], dtype=np.int64).copy()
    for row in parts:
        if row["ids"] is None:
            docs = np.frombuffer(row["doc"], dtype=np.uint16)
            score[docs] += np.frombuffer(row["score"])
            seen[docs] += np.frombuffer(row["seen"], dtype=np.int32)
    ids = pa.array(np.frombuffer(whole["ids"], dtype=np.int64), mask=np.frombuffer(whole["nulls"], dtype=bool))
    values = (whole["base"] + np.arange(len(ids)), ids, np.frombuffer(whole["sizes"], dtype=np.int64), seen, score)
    return pa.table({n: pa.array(x, t) for (n, t), x in zip(_DOCS.items(), values)})


def score(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", entries: int = ENTRIES, min_count: int = MIN_COUNT,
    leave_out: bool = False,
) -> DataFrame:
    """``doc_id, n_words, n_seen`` (bigrams that the table has) and
    ``score`` (sum of ln S) of every document. ``min_count`` cuts the bigram
    table. Whole, it has every bigram of the documents, and none backs off
    unless ``leave_out`` takes the scored occurrence out of the counts."""
    spark = docs.sparkSession
    less = int(leave_out)
    min_count += less
    texts = docs.select(F.col(text_col).cast("binary").alias("text"))
    uni_path, parts_path = scratch(spark, "unigrams"), scratch(spark, "lm-parts")
    _unigrams(texts).write.parquet(uni_path)
    uni = spark.read.parquet(uni_path)
    total = uni.where(F.col("h") != START).agg(F.sum("c").alias("n")).first()["n"] or 0
    known, known_c = _sorted(uni.where(F.col("c") * F.lit(KNOWN) >= F.lit(total)))
    hot = known[known_c * HOT >= total]
    codes, codes_c = _hot_pairs(texts, hot, max(total / HOT, min_count)) if len(hot) else (known[:0], known_c[:0])
    shared = spark.sparkContext.broadcast((known, known_c, hot, codes, codes_c))

    parts = max(1, -(-total // entries))
    numbered = docs.select(
        F.monotonically_increasing_id().alias("rid"), F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).cast("binary").alias("text"),
    )
    starts = uni.where(F.col("h") == START).agg(F.sum("c").alias("n")).first()["n"] or 0
    run, schema = _packed(shared, parts, min_count, starts, less)
    exploded = numbered.mapInArrow(run, schema)
    exploded.groupBy("p").applyInArrow(_joined(shared, max(total, 1), min_count, less), _ddl(_PARTS)).write.parquet(parts_path)
    found = spark.read.parquet(parts_path)
    packed = found.where("v is null").select("base", "doc", "score", "seen", "ids", "nulls", "sizes")
    scored = packed.groupBy("base").applyInArrow(_summed, _ddl(_DOCS))

    rest = F.lit(0.0)
    if min_count > 1:
        before = found.where("v is not null").join(uni, F.col("v") == F.col("h"))
        before = before.groupBy("rid").agg((-F.sum(F.col("n") * F.ln(F.col("c") - less))).alias("rest"))
        scored, rest = scored.join(before, "rid", "left"), F.coalesce("rest", rest)
    out = cut(scored.select("doc_id", "n_words", F.col("seen").alias("n_seen"), (F.col("score") + rest).alias("score")))
    remove(spark, uni_path)
    remove(spark, parts_path)
    return out
