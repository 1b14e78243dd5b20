"""Tokens of two tokenizers aligned, and scored by inverted pair bitmaps.

A text is cut into tokens twice: by a byte-level BPE (A, a ``tokenizers`` JSON
file) and by a piece BPE with byte fallback (B, a ``sentencepiece`` model). The
byte offsets where a token of each ends cut both sequences into groups; the two
tokens that end there are linked. A pair of ids scores by how often the whole
corpus links it, and is best when no other A id is linked to its B id more often.

Inverted index: a pair's postings are bitmaps of documents. Documents are
numbered inside containers (at most ``DOCS`` of them and about ``POSTINGS``
postings); a pair has a bitmap per container and multiplicity plane (plane k
holds the documents whose number of links has bit k set), stored as a sorted
list of 16-bit numbers or, where that is shorter, as bits. Tasks write partial
bitmaps (segments) as they go; a container's segments are OR-merged, the
planes' population counts add up to the links (2^k a document) and the counts
of the planes' union to the documents that hold the pair. Then the postings
return the scores: every bitmap hands its pair's count to its documents, and a
document adds them up.

Scale: texts are tokenised once, where they are read; what moves are segments
(about 2 bytes a document and pair). They are merged by container, whose size
is bounded, so a pair that all documents hold is one small row a container and
its counts are pre-aggregated sums. Linked tokens end at one byte, so one's
bytes end the other's: ``possible_pairs`` counts the pairs that two
vocabularies allow (274,882 here), whatever the corpus. The pair table is
broadcast while that bound times ``PAIR_BYTES`` is under ``BROADCAST``, else
joined as the planner likes. A text over ``PIECE`` characters is tokenised in
pieces, cut before single spaces between letters or digits, where neither
tokenizer joins anything. Both tokenizer files (at most ``FILE_BYTES``) are
read by the driver and broadcast.

Defined cases: null and empty texts, and texts that either tokenizer does not
give back byte for byte (say with U+2581 in them), have no tokens and an empty
``groups``; special-token strings in a text are ordinary text; a null id is
kept; repeated rows each give a row and each count; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trendstats.llm.common import cut
from trendstats.session import remove, scratch

A_FILE = "/opt/tokenizers/byte_bpe_50k.json"
B_FILE = "/opt/tokenizers/piece_bpe_32k.model"
FILE_BYTES = 32 << 20
PIECE = 1 << 16  # characters of a text worked on at once
BATCH = 1 << 18  # characters tokenised in one call
DOCS = 1 << 16  # documents of a container
POSTINGS = 1 << 21  # and about as many postings
SEGMENT = 1 << 19
BROADCAST = 64 << 20
PAIR_BYTES = 64  # a row of the pair table, generously

# Fixed value: the pattern that splits text before byte-level merges.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# What the fast encoder takes long for: left to the other one.
_LONG_RUN = re.compile(r"\s{1000}|\S{2000}")


def read_file(path: str) -> bytes:
    if os.path.getsize(path) > FILE_BYTES:
        raise ValueError(f"{path} has more than {FILE_BYTES} bytes")
    with open(path, "rb") as f:
        return f.read()


def _byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies write each byte as a printable character:
    printable Latin-1 as itself, the others as the characters from U+0100."""
    shown = [b for b in range(256) if 33 <= b <= 126 or (161 <= b and b != 173)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class ByteBpe:
    """Tokenizer A."""

    def __init__(self, content: bytes):
        self.content, self._slow = content, None
        spec = json.loads(content)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        byte = _byte_of_char()
        self.bytes: list[bytes] = [b""] * (1 + max([*vocab.values(), *(t["id"] for t in spec.get("added_tokens", ()))]))
        for entry, i in vocab.items():
            if all(c in byte for c in entry):
                self.bytes[i] = bytes(byte[c] for c in entry)
        # one number may serve as id and as merge rank if merges follow ids
        made = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in merges]
        pre = spec.get("pre_tokenizer") or {}
        plain = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
        single = {b: i for i, b in enumerate(self.bytes) if len(b) == 1}
        plain = plain and not spec.get("normalizer") and len(single) == 256 and max(single.values()) < min(made, default=1 << 31)
        self.fast = None
        if plain and all(x < y for x, y in zip(made, made[1:])):
            added = {t["id"] for t in spec.get("added_tokens", ())}
            ranks = {b: i for i, b in enumerate(self.bytes) if b and i not in added}
            self.fast = tiktoken.Encoding("a", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def slow(self):
        if self._slow is None:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            self._slow = Tokenizer.from_str(self.content.decode("utf-8"))
            self._slow.encode_special_tokens = True
        return self._slow

    def encode(self, pieces: list[str]) -> list[list[int]]:
        out = []
        for piece in pieces:
            if self.fast is not None and not _LONG_RUN.search(piece):
                out.append(self.fast.encode_ordinary(" " + piece))
            else:
                out.append(self.slow().encode(" " + piece, add_special_tokens=False).ids)
        return out


class PieceBpe:
    """Tokenizer B (it adds the leading space itself)."""

    def __init__(self, content: bytes):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=content)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        byte = [self.model.is_byte(i) for i in range(len(names))]
        self.bytes = [bytes([int(n[3:5], 16)]) if b else n.replace("▁", " ").encode() for n, b in zip(names, byte)]
        self.bounded = not any("▁" in n.lstrip("▁") for n in names)  # no piece holds a space after something else

    def encode(self, pieces: list[str]) -> list[list[int]]:
        return self.model.encode(pieces, num_threads=1)


def possible_pairs(a: list[bytes], b: list[bytes]) -> int:
    """Pairs whose tokens can end at one byte: one's bytes end the other's."""
    in_a, in_b = set(filter(None, a)), set(filter(None, b))
    ends = sum(t[k:] in in_b for t in a if t for k in range(len(t)))
    return ends + sum(t[k:] in in_a for t in b if t for k in range(1, len(t)))


def pieces_of(text: str, limit: int) -> list[str]:
    """``text`` in pieces of about ``limit`` characters: a space and the
    pieces, each with a space before it, are the space and the text."""
    out, start = [], 0
    while len(text) - start > limit:
        at = text.rfind(" ", start + 1, start + limit)
        while at > start and not (text[at - 1].isalnum() and text[at + 1].isalnum()):
            at = text.rfind(" ", start + 1, at)
        if at <= start:
            at = text.find(" ", start + limit)
            while 0 < at < len(text) - 1 and not (text[at - 1].isalnum() and text[at + 1].isalnum()):
                at = text.find(" ", at + 1)
            if at < 0 or at >= len(text) - 1:
                break
        out.append(text[start:at])
        start = at + 1
    out.append(text[start:])
    return out


class Aligner:
    def __init__(self, a: bytes, b: bytes, piece: int):
        self.a, self.b = ByteBpe(a), PieceBpe(b)
        self.size_a, self.size_b = (np.array([len(t) for t in x.bytes], dtype=np.int64) for x in (self.a, self.b))
        self.piece = piece if self.a.fast is not None and self.b.bounded else 1 << 60
        ids = max(len(self.a.bytes), len(self.b.bytes))
        width = len(str(ids))
        padded = "".join(str(i).rjust(width, "\0") for i in range(ids))
        self.digits = np.frombuffer(padded.encode(), dtype=np.uint8).reshape(-1, width)

    def align(self, piece: str, ids_a: list[int], ids_b: list[int]):
        """(A ids, B ids, last A index of each group, last B index) or None
        where a tokenizer does not give the bytes back."""
        data = (" " + piece).encode("utf-8")
        for ids, known in ((ids_a, self.a.bytes), (ids_b, self.b.bytes)):
            if b"".join([known[i] for i in ids]) != data:
                return None
        a, b = np.array(ids_a, dtype=np.int64), np.array(ids_b, dtype=np.int64)
        ends_a, ends_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        at = np.searchsorted(ends_b, ends_a)
        meets = ends_b[at] == ends_a
        return a, b, np.flatnonzero(meets), at[meets]

    def listed(self, a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray) -> bytes:
        """``a1,a2|b1;a3|b2,b3``."""
        before_b = np.concatenate(([0], last_b[:-1] + 1))
        at_a = np.arange(len(a)) + np.repeat(before_b, np.diff(last_a, prepend=-1))
        at_b = np.arange(len(b)) + np.repeat(last_a + 1, np.diff(last_b, prepend=-1))
        width = self.digits.shape[1]
        text = np.empty((len(a) + len(b), width + 1), dtype=np.uint8)
        text[at_a, :width], text[at_b, :width] = self.digits[a], self.digits[b]
        text[:, width] = ord(",")
        text[at_a[last_a], width], text[at_b[last_b], width] = ord("|"), ord(";")
        flat = text.ravel()
        return flat[flat != 0].tobytes()[:-1]


_ALIGNERS: dict[tuple[bytes, bytes, int], Aligner] = {}


def aligner(a: bytes, b: bytes, piece: int) -> Aligner:
    key = (hashlib.sha256(a).digest(), hashlib.sha256(b).digest(), piece)
    if key not in _ALIGNERS:
        _ALIGNERS[key] = Aligner(a, b, piece)
    return _ALIGNERS[key]


class _Document:
    """Sums over a document's pieces."""

    def __init__(self, digest: bool):
        self.n_a = self.n_b = self.n_links = 0
        self.text = hashlib.sha256() if digest else []
        self.pairs, self.whole = [], True

    def add(self, aligned, listed: bytes) -> None:
        a, b, last_a, last_b = aligned
        if self.n_links:
            listed = b";" + listed
        if isinstance(self.text, list):
            self.text.append(listed)
        else:
            self.text.update(listed)
        self.n_a, self.n_b, self.n_links = self.n_a + len(a), self.n_b + len(b), self.n_links + len(last_a)
        self.pairs.append(np.unique(a[last_a] << 32 | b[last_b], return_counts=True))

    def postings(self) -> tuple[np.ndarray, np.ndarray]:
        if len(self.pairs) == 1:
            return self.pairs[0]
        pair, back = np.unique(np.concatenate([p for p, _ in self.pairs]), return_inverse=True)
        many = np.zeros(len(pair), dtype=np.int64)
        np.add.at(many, back, np.concatenate([n for _, n in self.pairs]))
        return pair, many

    def groups(self) -> str:
        if not self.n_links:
            return ""
        return b"".join(self.text).decode() if isinstance(self.text, list) else self.text.hexdigest()


# --- bitmaps -----------------------------------------------------------------

_ROWS = {"container": pa.int64(), "pair": pa.int64(), "plane": pa.int32(), "dense": pa.bool_(), "bits": pa.binary(), "n": pa.int64(), "n_docs": pa.int64()}


def encode(container: int, pair: np.ndarray, plane: np.ndarray, doc: np.ndarray) -> Iterator[dict]:
    """Bitmap rows of postings in (pair, plane, document) order."""
    if not len(pair):
        return
    new = np.ones(len(pair), dtype=bool)
    new[1:] = (pair[1:] != pair[:-1]) | (plane[1:] != plane[:-1])
    starts = np.flatnonzero(new)
    counts = np.diff(np.append(starts, len(pair)))
    size = -(-(int(doc.max()) + 1) // 8)
    dense = counts * 2 > size
    # documents of a pair: of its planes' union, told by the pair's first row
    heads = np.flatnonzero(np.concatenate(([True], pair[starts][1:] != pair[starts][:-1])))
    firsts = np.append(starts[heads], len(pair))
    n_docs = np.zeros(len(starts), dtype=np.int64)
    for h, lo, hi, rows in zip(heads, firsts[:-1], firsts[1:], np.diff(np.append(heads, len(starts)))):
        n_docs[h] = hi - lo if rows == 1 else len(np.unique(doc[lo:hi]))
    base = {"container": lambda k: np.full(k, container), "pair": pair[starts], "plane": plane[starts], "n": counts, "n_docs": n_docs}
    sparse = np.flatnonzero(~dense)
    if len(sparse):
        offsets = np.concatenate(([0], np.cumsum(counts[sparse] * 2))).astype(np.int32)
        data = doc[np.repeat(~dense, counts)].astype("<u2").tobytes()
        yield _batch(base, sparse, False, pa.Array.from_buffers(pa.binary(), len(sparse), [None, pa.py_buffer(offsets), pa.py_buffer(data)]))
    full = np.flatnonzero(dense)
    if len(full):
        bits = []
        for lo, n in zip(starts[full], counts[full]):
            flags = np.zeros(size * 8, dtype=np.uint8)
            flags[doc[lo : lo + n]] = 1
            bits.append(np.packbits(flags).tobytes())
        yield _batch(base, full, True, pa.array(bits, pa.binary()))


def _batch(base: dict, at: np.ndarray, dense: bool, bits: pa.Array) -> dict:
    cols = {name: base[name](len(at)) if name == "container" else base[name][at] for name in base}
    return cols | {"dense": np.full(len(at), dense), "bits": bits}


def decode(dense: np.ndarray, bits: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, document) of every set bit of the bitmaps."""
    rows, docs = [], []
    sparse = np.flatnonzero(~dense)
    if len(sparse):
        taken = bits.take(pa.array(sparse))
        offsets = np.frombuffer(taken.buffers()[1], dtype=np.int32)[taken.offset : taken.offset + len(sparse) + 1]
        rows.append(np.repeat(sparse, np.diff(offsets) // 2))
        docs.append(np.frombuffer(taken.buffers()[2], dtype="<u2", count=(offsets[-1] - offsets[0]) // 2, offset=int(offsets[0])))
    for k in np.flatnonzero(dense):
        found = np.flatnonzero(np.unpackbits(np.frombuffer(bits[int(k)].as_py(), dtype=np.uint8)))
        rows.append(np.full(len(found), k))
        docs.append(found)
    if not rows:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    return np.concatenate(rows), np.concatenate(docs).astype(np.int64)


def planes_of(pair: np.ndarray, doc: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Postings with multiplicities as (pair, plane, document), in order."""
    found = []
    for k in range(int(many.max(initial=0)).bit_length()):
        has = (many >> k & 1).astype(bool)
        found.append((pair[has], np.full(int(has.sum()), k, dtype=np.int32), doc[has]))
    pair, plane, doc = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((doc, plane, pair))
    return pair[order], plane[order], doc[order]


_DOC = {"rid": pa.int64(), "doc_id": pa.int64(), "at": pa.int64(), "n_a": pa.int64(), "n_b": pa.int64(), "n_links": pa.int64(), "groups": pa.string()}
_KINDS = {"container": pa.int64()} | _DOC | {k: t for k, t in _ROWS.items() if k != "container"}
_NAMES = {pa.int64(): "long", pa.int32(): "int", pa.bool_(): "boolean", pa.binary(): "binary", pa.string(): "string"}


def _ddl(kinds: dict) -> str:
    return ", ".join(f"`{k}` {_NAMES[t]}" for k, t in kinds.items())


def _record(cols: dict, kinds: dict) -> pa.RecordBatch:
    n = len(next(iter(cols.values())))
    return pa.RecordBatch.from_arrays([pa.array(cols[k], t) if k in cols else pa.nulls(n, t) for k, t in kinds.items()], names=list(kinds))


def _index(shared, piece: int, digest: bool, segment: int, limits: tuple[int, int]):
    """Document rows and bitmap segments of the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = aligner(*shared.value, piece)
        container, docs, total, held, rows = None, 0, 0, [], []

        def flush():
            nonlocal held, rows
            if rows:
                yield _record(dict(zip(("container", *_DOC), zip(*rows))), _KINDS)
            if held:
                pair, doc, many = (np.concatenate(x) for x in zip(*held))
                for cols in encode(container, *planes_of(pair, doc, many)):
                    yield _record(cols, _KINDS)
            held, rows = [], []

        def documents():
            """Finished documents, tokenised many pieces at a time."""
            waiting, size = [], 0  # (rid, id, pieces)
            for batch in batches:
                for rid, i, text in zip(*(batch.column(c) for c in ("rid", "doc_id", "text"))):
                    text = text.as_py()
                    waiting.append((rid.as_py(), i.as_py(), pieces_of(text, tool.piece) if text else []))
                    size += len(text or "")
                    if size >= BATCH:
                        yield from tokenised(waiting)
                        waiting, size = [], 0
            yield from tokenised(waiting)

        def tokenised(waiting):
            flat = [p for _, _, pieces in waiting for p in pieces]
            coded = iter(())
            at, sizes = 0, []
            for rid, i, pieces in waiting:
                doc = _Document(digest)
                for p in pieces:
                    if at >= sum(sizes):  # the next pieces, about BATCH characters
                        end, n = at, 0
                        while end < len(flat) and (n < BATCH or end == at):
                            n += len(flat[end])
                            end += 1
                        coded = iter(zip(tool.a.encode(flat[at:end]), tool.b.encode(flat[at:end])))
                        sizes = [end]
                    ids_a, ids_b = next(coded)
                    at += 1
                    aligned = tool.align(p, ids_a, ids_b) if doc.whole else None
                    if aligned is None:
                        doc = _Document(digest)
                        doc.whole = False
                    else:
                        doc.add(aligned, tool.listed(*aligned))
                yield rid, i, doc

        waiting = 0
        for rid, i, doc in documents():
            if container is None or docs >= limits[0] or total >= limits[1]:
                yield from flush()
                container, docs, total, waiting = rid, 0, 0, 0
            rows.append((container, rid, i, docs, doc.n_a, doc.n_b, doc.n_links, doc.groups()))
            if doc.pairs:
                pair, many = doc.postings()
                held.append((pair, np.full(len(pair), docs, dtype=np.int64), many))
                total += len(pair)
                waiting += len(pair)
            docs += 1
            if waiting >= segment:
                yield from flush()
                waiting = 0
        yield from flush()

    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A container's segments, OR-merged bitmap by bitmap."""

    def out(number: int, held: list) -> Iterator[pa.RecordBatch]:
        pair, plane, doc = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((doc, plane, pair))
        pair, plane, doc = pair[order], plane[order], doc[order]
        one = np.ones(len(pair), dtype=bool)  # a bit set by two segments is one bit
        one[1:] = (pair[1:] != pair[:-1]) | (plane[1:] != plane[:-1]) | (doc[1:] != doc[:-1])
        for cols in encode(number, pair[one], plane[one], doc[one]):
            yield _record(cols, _ROWS)

    number, held = None, []
    for batch in batches:
        containers = batch.column("container").to_numpy()
        edges = np.concatenate(([0], np.flatnonzero(np.diff(containers)) + 1, [len(containers)]))
        for lo, hi in zip(edges[:-1], edges[1:]):
            if lo == hi:
                continue
            if containers[lo] != number and held:
                yield from out(number, held)
                held = []
            number, part = int(containers[lo]), batch.slice(lo, hi - lo)
            row, doc = decode(part.column("dense").to_numpy(zero_copy_only=False), part.column("bits"))
            held.append((part.column("pair").to_numpy()[row], part.column("plane").to_numpy()[row], doc.astype(np.int32)))
    if held:
        yield from out(number, held)


def _scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each bitmap hands its pair's score to its documents."""

    def out(number: int, sums: np.ndarray) -> pa.RecordBatch:
        has = np.flatnonzero(sums.any(axis=0))
        cols = [np.full(len(has), number), has, sums[0][has], sums[1][has]]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["container", "at", "count_sum", "n_best"])

    number, sums = None, np.zeros((2, 0), dtype=np.int64)
    for batch in batches:
        containers = batch.column("container").to_numpy()
        row, doc = decode(batch.column("dense").to_numpy(zero_copy_only=False), batch.column("bits"))
        weight = np.int64(1) << batch.column("plane").to_numpy().astype(np.int64)
        score = weight * batch.column("n_links").to_numpy()
        best = weight * batch.column("best").to_numpy(zero_copy_only=False)
        order = np.argsort(containers[row], kind="stable")
        row, doc = row[order], doc[order]
        edges = np.concatenate(([0], np.flatnonzero(np.diff(containers[row])) + 1, [len(row)]))
        for lo, hi in zip(edges[:-1], edges[1:]):
            if lo == hi:
                continue
            if containers[row[lo]] != number:
                if number is not None:
                    yield out(number, sums)
                number, sums = int(containers[row[lo]]), np.zeros((2, 0), dtype=np.int64)
            most = int(doc[lo:hi].max()) + 1
            if most > sums.shape[1]:
                sums = np.pad(sums, ((0, 0), (0, most - sums.shape[1])))
            np.add.at(sums[0], doc[lo:hi], score[row[lo:hi]])
            np.add.at(sums[1], doc[lo:hi], best[row[lo:hi]])
    if number is not None:
        yield out(number, sums)


def align(
    docs: DataFrame, a: bytes, b: bytes, id_col: str = "doc_id", text_col: str = "text", digest: bool = False, piece: int = PIECE,
    segment: int = SEGMENT, limits: tuple[int, int] = (DOCS, POSTINGS),
) -> tuple[DataFrame, DataFrame]:
    """Documents (``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``,
    ``n_best``, ``count_sum``, ``groups``) and pairs (``a``, ``b``,
    ``n_links``, ``n_docs``, ``best``). ``a`` and ``b`` are the contents of the
    tokenizer files. ``groups`` is the text ``a1,a2|b1;a3|b2,b3``, or with
    ``digest`` its SHA-256, which spares the disk ten times the tokens."""
    if limits[0] > DOCS:
        raise ValueError(f"a container holds at most {DOCS} documents")
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((a, b))
    texts = docs.select(
        F.monotonically_increasing_id().alias("rid"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")
    )
    indexed, merged = scratch(spark, "alignment"), scratch(spark, "postings")
    texts.mapInArrow(_index(shared, piece, digest, segment, limits), _ddl(_KINDS)).write.parquet(indexed)
    written = spark.read.parquet(indexed)

    segments = written.where("pair is not null").select(*_ROWS)
    segments.repartition("container").sortWithinPartitions("container").mapInArrow(_merge, _ddl(_ROWS)).write.parquet(merged)
    postings = spark.read.parquet(merged)
    counts = postings.groupBy("pair").agg(
        F.sum(F.expr("n * shiftleft(1L, plane)")).alias("n_links"), F.sum("n_docs").alias("n_docs")
    )
    b_id = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    most = F.max("n_links").over(Window.partitionBy("b"))
    pairs = cut(
        counts.select("pair", F.shiftright("pair", 32).alias("a"), b_id.alias("b"), "n_links", "n_docs")
        .withColumn("best", F.col("n_links") == most)
    )

    table = pairs.select("pair", "n_links", "best")
    if possible_pairs(ByteBpe(a).bytes, PieceBpe(b).bytes) * PAIR_BYTES <= BROADCAST:
        table = F.broadcast(table)
    scored = postings.select("container", "pair", "plane", "dense", "bits").join(table, "pair")
    scored = scored.mapInArrow(_scores, "container long, at long, count_sum long, n_best long")
    sums = scored.groupBy("container", "at").agg(F.sum("count_sum").alias("count_sum"), F.sum("n_best").alias("n_best"))
    known = written.where("rid is not null").select("container", *_DOC)
    zero = F.lit(0).cast("long")
    found = cut(
        known.join(sums, ["container", "at"], "left").select(
            "doc_id", "n_a", "n_b", F.col("n_links").alias("n_groups"), "n_links",
            F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups",
        )
    )
    remove(spark, indexed)
    remove(spark, merged)
    return found, pairs.drop("pair")
