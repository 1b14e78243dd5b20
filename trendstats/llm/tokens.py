"""Token counts by separator scan over flat token files.

A flat token file is a run of fixed-width token ids; each document ends with
an end-of-document id, and there is no index. ``count_documents`` finds the
documents: every file is cut into blocks, one vectorised comparison per block
gives the separators, and documents inside a block are done. What a block
holds before its first and after its last separator are fragments; a prefix
scan over the blocks' separator counts numbers the document that each
fragment belongs to, and the fragments of a number are added up.

``write_token_files`` makes such files from texts with a public tokenizer
(16-bit big-endian ids). Each document starts with ``HEADER`` tokens that
spell its id in base 2^15, so that files need no index to be read back.

Scale: texts are tokenised where they are read and each task writes its own
files (no shuffle, no sort). Files are cut by bytes: one holds at most
``FILE_BYTES``, or a single longer document. The scan reads a file per row
(``binaryFile``, at most 2 GB a file) and moves only counts: a row per block
and the fragments. The tokenizer's rank file (at most ``RANK_BYTES``) is read
by the driver and broadcast.

Defined cases: a null or empty text has 0 tokens; special-token strings in a
text are ordinary text; a null id comes back as null; repeated rows each get
a row; two separators in a row are a document of 0 tokens; tokens after the
last separator of a file are a document of their own; an empty table or an
empty file has no document; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trendstats.llm.common import cut
from trendstats.session import remove, scratch

RANK_FILE = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
RANK_BYTES = 16 << 20
# Fixed value: the pattern that splits text before the merges of a rank file.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Runs of white space that the pattern's look-ahead would overflow on.
_LONG_RUN = regex.compile(r"\p{White_Space}{10000,}")
# The separator: an id beyond the vocabulary whose two bytes are one UTF-8
# character, so that Spark's text writer can put it after every document.
SEPARATOR = "Ā"
EOS = int.from_bytes(SEPARATOR.encode("utf-8"), "big")
DTYPE = ">u2"
HEADER, BASE = 5, 1 << 15
NO_ID = BASE**HEADER - 1  # no 64-bit number
FILE_BYTES = 8 << 20
BLOCK = 1 << 18  # tokens

_ENCODINGS: dict[str, tiktoken.Encoding] = {}


def encoding(ranks: bytes) -> tiktoken.Encoding:
    """The encoding of a rank file's content (kept for this process)."""
    key = hashlib.sha256(ranks).hexdigest()
    if key not in _ENCODINGS:
        merges = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
        _ENCODINGS[key] = tiktoken.Encoding(key, pat_str=SPLIT, mergeable_ranks=merges, special_tokens={})
    return _ENCODINGS[key]


def encode_text(coder: tiktoken.Encoding, text: str) -> list[int]:
    """Token ids of a text. The pattern takes a run of white space up to the
    end of the text as one piece, and before another character all of it but
    its last: long runs are cut out here the same way."""
    out, at = [], 0
    for run in _LONG_RUN.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        out += coder.encode_ordinary(text[at : run.start()])
        out += coder._encode_single_piece(text[run.start() : end].encode("utf-8"))
        at = end
    return out + coder.encode_ordinary(text[at:]) if at else coder.encode_ordinary(text)


def read_ranks(path: str = RANK_FILE) -> bytes:
    if os.path.getsize(path) > RANK_BYTES:
        raise ValueError(f"{path} has more than {RANK_BYTES} bytes")
    with open(path, "rb") as f:
        return f.read()


def header(doc_id: int | None) -> list[int]:
    value = NO_ID if doc_id is None else doc_id % (1 << 64)
    return [value // BASE**k % BASE for k in range(HEADER)]


def write_token_files(
    docs: DataFrame, path: str, ranks: bytes, id_col: str = "doc_id", text_col: str = "text", file_bytes: int = FILE_BYTES
) -> None:
    """Token files of ``docs`` in the folder ``path``, each of at most
    ``file_bytes`` bytes or of one document."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, between = encoding(shared.value), SEPARATOR.encode("utf-8")
        if coder.n_vocab > EOS:
            raise ValueError("the separator is a token of this vocabulary")
        held: list[bytes] = []
        size = 0
        for batch in batches:
            for i, text in zip(batch.column(0), batch.column(1)):
                i, text = i.as_py(), text.as_py()
                tokens = header(None if i is None else int(i)) + (encode_text(coder, text) if text else [])
                data = np.array(tokens, dtype=DTYPE).tobytes()
                if held and size + len(data) + len(between) > file_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([between.join(held)], pa.binary())], ["value"])
                    held, size = [], 0
                held.append(data)
                size += len(data) + len(between)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([between.join(held)], pa.binary())], ["value"])

    slim = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    files = slim.mapInArrow(encoded, "value binary").select(F.col("value").cast("string").alias("value"))
    # a row is a file; the writer adds the last separator
    files.write.option("lineSep", SEPARATOR).option("maxRecordsPerFile", 1).text(path)


def scan_block(tokens: np.ndarray, eos: int, heads: int) -> dict:
    """Documents inside a block and the fragments at its ends, with the first
    ``heads`` tokens of each."""
    ends = np.flatnonzero(tokens == eos)
    starts = ends[:-1] + 1
    inner = ends[1:] - starts
    first = np.full((len(inner), heads), -1, dtype=np.int64)
    for k in range(heads):
        has = inner > k
        first[has, k] = tokens[starts[has] + k]
    head = tokens[: ends[0]] if len(ends) else tokens
    tail = tokens[ends[-1] + 1 :] if len(ends) else tokens[:0]
    return {
        "seps": len(ends), "inner": inner, "inner_first": first.ravel(),
        "head": len(head), "head_first": head[:heads].astype(np.int64),
        "tail": len(tail), "tail_first": tail[:heads].astype(np.int64),
    }


def _scan(dtype: str, eos: int, heads: int, block: int):
    kinds = {
        "file": pa.string(), "block": pa.int64(), "seps": pa.int64(), "inner": pa.list_(pa.int64()),
        "inner_first": pa.list_(pa.int64()), "head": pa.int64(), "head_first": pa.list_(pa.int64()),
        "tail": pa.int64(), "tail_first": pa.list_(pa.int64()),
    }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1)):
                tokens = np.frombuffer(content.as_buffer() or b"", dtype=dtype)
                for b, at in enumerate(range(0, len(tokens), block)):
                    row = {"file": path.as_py(), "block": b} | scan_block(tokens[at : at + block], eos, heads)
                    yield pa.RecordBatch.from_arrays([pa.array([row[n]], t) for n, t in kinds.items()], list(kinds))

    schema = ", ".join(
        f"{n} {'string' if t == pa.string() else 'long' if t == pa.int64() else 'array<long>'}" for n, t in kinds.items()
    )
    return run, schema


def count_documents(
    spark: SparkSession, path: str, dtype: str = DTYPE, eos: int = EOS, heads: int = HEADER, block: int = BLOCK
) -> DataFrame:
    """``n_tokens`` and ``first`` (the first ``heads`` tokens, fewer if the
    document has fewer) of every document of the flat files in ``path``."""
    run, schema = _scan(dtype, eos, heads, block)
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    blocks = cut(files.mapInArrow(run, schema))
    starts = F.sequence(F.lit(0), F.size("inner") - 1)
    firsts = F.transform(
        starts,
        lambda i: F.filter(F.slice("inner_first", i * heads + 1, F.lit(heads)), lambda t: t >= 0)
        if heads else F.array().cast("array<long>"),
    )
    inside = blocks.where(F.size("inner") > 0).select(F.explode(F.arrays_zip("inner", firsts.alias("first"))).alias("d"))
    inside = inside.select(F.col("d.inner").alias("n_tokens"), F.col("d.first").alias("first"))

    # prefix scan: separators before a block number its open document
    order = Window.partitionBy("file").orderBy("block")
    numbered = blocks.select(
        "file", "block", "seps", "head", "head_first", "tail", "tail_first",
        F.coalesce(F.sum("seps").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("open"),
        F.sum("seps").over(Window.partitionBy("file")).alias("closed"),
    )
    ends = F.array(
        F.struct(F.col("open").alias("doc"), F.col("head").alias("n"), F.col("head_first").alias("f")),
        F.when(
            F.col("seps") > 0,
            F.struct((F.col("open") + F.col("seps")).alias("doc"), F.col("tail").alias("n"), F.col("tail_first").alias("f")),
        ),
    )
    pieces = numbered.select("file", "block", "closed", F.explode(F.array_compact(ends)).alias("p"))
    stitched = pieces.groupBy("file", F.col("p.doc").alias("doc"), "closed").agg(
        F.sum("p.n").alias("n_tokens"),
        # the first tokens: fragments shorter than that (only the first and
        # the last of a document can be), then the first long one
        F.sort_array(F.collect_list(F.when(F.size("p.f") < heads, F.struct("block", F.col("p.f").alias("f"))))).alias("short"),
        F.min(F.when(F.size("p.f") >= heads, F.struct("block", F.col("p.f").alias("f")))).alias("full"),
    )
    # short fragments before the first long one, then the long one
    short = F.filter("short", lambda s: F.col("full").isNull() | (s["block"] <= F.col("full.block")))
    first = F.concat(F.flatten(F.transform(short, lambda s: s["f"])), F.coalesce(F.col("full.f"), F.array().cast("array<long>")))
    stitched = stitched.where((F.col("doc") < F.col("closed")) | (F.col("n_tokens") > 0))
    return inside.union(stitched.select("n_tokens", F.slice(first, 1, max(heads, 1)).alias("first")))


def id_of(first):
    """The document id that a header spells."""
    value = F.lit(0).cast("decimal(38,0)")
    for k in reversed(range(HEADER)):
        value = value * F.lit(BASE).cast("decimal(6,0)") + F.get(first, F.lit(k)).cast("decimal(6,0)")
        value = value.cast("decimal(38,0)")
    top = F.lit(str(1 << 63)).cast("decimal(38,0)")
    signed = F.when(value >= top, value - F.lit(str(1 << 64)).cast("decimal(38,0)")).otherwise(value)
    return F.when(value < F.lit(str(NO_ID)).cast("decimal(38,0)"), signed).cast("long")


def token_counts(
    docs: DataFrame, ranks: bytes, id_col: str = "doc_id", text_col: str = "text", file_bytes: int = FILE_BYTES
) -> DataFrame:
    """``doc_id`` and ``n_tokens`` of every document, counted in flat token
    files that are written to the shared folder and removed afterwards."""
    spark = docs.sparkSession
    path = scratch(spark, "tokens")
    write_token_files(docs, path, ranks, id_col, text_col, file_bytes)
    counted = cut(count_documents(spark, path).select(id_of(F.col("first")).alias("doc_id"), (F.col("n_tokens") - HEADER).alias("n_tokens")))
    remove(spark, path)
    return counted
