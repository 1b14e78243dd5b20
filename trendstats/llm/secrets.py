"""Secrets: base patterns plus dictionary-primed zstandard novelty.

Base spans come from three fixed patterns. The method adds spans: a token of
``TOKEN`` or more characters next to a sensitive word is a candidate; its
novelty is the number of bytes that it adds when the text around it is
compressed with a dictionary of the corpus' most frequent identifiers. Words
and names that occur around it or in the dictionary cost next to nothing;
a random string costs about what its alphabet needs, less
where the text around it lends its tables. A candidate is reported when its
novelty reaches a share of that need calibrated by alphabet and length:
random tokens of each alphabet are put at a random place of every ``PIECE``
characters of all texts, and the share is the one that ``RECALL`` of them reach, or ``NOVELTY`` if more do. Tokens of
letters only, which words may be, are asked for ``RECALL_LETTERS``.

Scale: documents are scanned in Arrow batches. The dictionary counts each
identifier once in each distinct text, so one shuffle brings copies of a text
together (one row of each text hash leaves a task), and partial counts leave
each task; the driver sees its ``IDENTIFIERS`` words only. The
calibration takes part of every document in place (a copy counts like any
other) and brings back how often each share occurred, which is a number of
bytes for each alphabet and length. An identifier that
in half of its texts or more lies in a candidate is no word of the dictionary,
so that a secret on many pages does not hide itself.

Defined cases: null and empty texts have no span; repeated rows each get a
result; a candidate that overlaps a base span is not added again; an empty
table, or a corpus without identifiers, gives an empty dictionary, and
candidates are then measured against their surroundings only; without a
text the share is ``NOVELTY`` for all; other columns
stay as they are.
"""

from __future__ import annotations

import math
import random
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendstats.llm.common import topmost

KINDS = ("assign", "access", "hex")

# --- fixed values: the base patterns -----------------------------------------
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 12, "access": 18, "hex": 16}  # characters (assign: of group 2)
# --- end of fixed values -----------------------------------------------------

ADDED = "novel"
TOKEN = 16  # characters of a candidate
CONTEXT = 256  # characters before and after that prime the compressor
NEAR = 40  # a sensitive word must end so close before the candidate
NOVELTY = 1.0
RECALL, RECALL_LETTERS = 0.98, 0.9  # of random tokens, by calibration
PIECE = 4096  # characters that the calibration takes a place of
TRIES = 1000  # random tokens of an alphabet and length, about, where there are fewer places
LENGTHS = (16, 18, 20, 22, 24, 28, 32, 40, 48, 64)
_DIGITS, _LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
ALPHABETS = {  # as ``_class`` tells them apart
    "digits": _DIGITS, "hex": _DIGITS + "abcdef", "one case": _DIGITS + _LOWER, "mixed": _DIGITS + _LOWER + _LOWER.upper() + "+/",
    "letters of one case": _LOWER, "letters": _LOWER + _LOWER.upper(),
}
IDENTIFIERS = 4096
LEVEL = 9
_CUES = ("password", "passwd", "secret", "token", "key", "credential", "auth", "bearer", "private")
_HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")

_ASSIGN = re.compile(ASSIGN, re.A | re.I)
_ACCESS = re.compile(ACCESS)
_HEX = re.compile(f"[0-9a-f]{{{LEAST['hex']},}}")  # runs shorter than that fail
_TOKEN = re.compile(f"[A-Za-z0-9+/_=-]{{{TOKEN},}}")
_IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_]{2,31}")
_FLUSH = 200_000


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    """``(start, kind number, end)`` in order."""
    if not text:
        return []
    out = []
    low = text.lower()  # only to see whether the slow pattern can match at all
    if any(h in low for h in _HINTS):
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m.group(2)) >= LEAST["assign"]]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


def _alphabet(token: str) -> int:
    """Size of the smallest usual alphabet that holds the token."""
    if re.fullmatch("[0-9]+", token):
        return 10
    if re.fullmatch("[0-9a-f]+|[0-9A-F]+", token):
        return 16
    if re.fullmatch("[0-9a-z]+|[0-9A-Z]+", token):
        return 36
    return 64


def _class(token: str) -> str:
    if not re.search("[0-9+/=]", token):
        return "letters of one case" if re.fullmatch("[a-z_-]+|[A-Z_-]+", token) else "letters"
    return {10: "digits", 16: "hex", 36: "one case", 64: "mixed"}[_alphabet(token)]


class Novelty:
    """Marginal compressed size of a token in its surroundings; ``least``
    holds the calibrated shares of ``(class, length)``."""

    def __init__(self, identifiers: list[str], least: dict[tuple[str, int], float] | None = None):
        self.least = least or {}
        words = " ".join(reversed(identifiers)).encode()  # the most frequent last, where matches are cheapest
        self.compressor = zstandard.ZstdCompressor(
            level=LEVEL,
            dict_data=zstandard.ZstdCompressionDict(words, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if words else None,
        )

    def share(self, text: str, start: int, end: int) -> float:
        """Bytes that the token adds, as a share of what a random string
        over its alphabet needs."""
        token = text[start:end]
        around = (text[max(0, start - CONTEXT) : start] + " " + text[end : end + CONTEXT]).encode("utf-8", "replace")
        size = lambda b: len(self.compressor.compress(b))
        added = size(around + b" " + token.encode()) - size(around)
        return 8 * added / (len(token) * math.log2(_alphabet(token)))


    def reached(self, text: str, start: int, end: int) -> bool:
        length = max((n for n in LENGTHS if n <= end - start), default=LENGTHS[0])
        least = self.least.get((_class(text[start:end]), length), NOVELTY)
        return self.share(text, start, end) >= least


def _at_places(text: str, h: int, each: int, novelty: Novelty) -> Iterator[tuple[str, int, float]]:
    """Class, length and share of ``each`` random tokens of each alphabet at a
    random place of every piece of the text."""
    for lo in range(0, len(text), PIECE):
        rng = random.Random((h << 32) + lo)  # the same on every run
        for name, letters in ALPHABETS.items():
            first = rng.randrange(len(LENGTHS))
            for i in range(each):
                n = LENGTHS[(first + i) % len(LENGTHS)]
                token = "".join(rng.choices(letters, k=n))
                if _class(token) != name:
                    token = token[:-1] + rng.choice(_DIGITS)  # a token of this alphabet without a digit
                at = rng.randint(lo, min(len(text), lo + PIECE))
                before = f"{text[max(0, at - CONTEXT) : at]} {rng.choice(_CUES)} "
                yield name, n, novelty.share(f"{before}{token} {text[at : at + CONTEXT]}", len(before), len(before) + n)


def shares(docs: DataFrame, identifiers: list[str], text_col: str = "text") -> DataFrame:
    """How often (``count``) a random token of each ``class`` and ``length``
    had each ``share`` at the places of all documents; each of these gets
    about ``TRIES`` tokens or more."""
    texts = docs.select(F.col(text_col).alias("text"), F.xxhash64(text_col).alias("h")).where("length(text) > 0")
    pieces = texts.agg(F.sum(F.ceil(F.length("text") / PIECE)).alias("n")).first()["n"] or 1
    each = math.ceil(TRIES * len(LENGTHS) / int(pieces))
    shared = docs.sparkSession.sparkContext.broadcast(identifiers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty, counts = Novelty(shared.value), Counter()
        for batch in batches:
            for text, h in zip(*(column.to_pylist() for column in batch.columns)):
                counts.update(_at_places(text, h, each, novelty))
        rows = [(*key, n) for key, n in counts.items()]
        kinds = (pa.string(), pa.int32(), pa.float64(), pa.int64())
        columns = zip(*rows) if rows else [()] * len(kinds)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["class", "length", "share", "count"])

    counted = texts.mapInArrow(run, "class string, length int, share double, count long")
    return counted.groupBy("class", "length", "share").agg(F.sum("count").alias("count"))


def calibrated(docs: DataFrame, identifiers: list[str], text_col: str = "text") -> dict[tuple[str, int], float]:
    """Share of its need that random tokens reach, by class and length."""
    found: dict[tuple[str, int], list[tuple[float, int]]] = {}
    for r in shares(docs, identifiers, text_col).collect():
        found.setdefault((r["class"], r["length"]), []).append((r["share"], r["count"]))
    out = {}
    for key, counts in found.items():
        recall = RECALL_LETTERS if key[0].startswith("letters") else RECALL
        missed = int((1 - recall) * sum(n for _, n in counts))
        for share, n in sorted(counts):
            missed -= n
            if missed < 0:
                out[key] = min(NOVELTY, share)
                break
    return out


def candidate_spans(text: str | None) -> list[tuple[int, int]]:
    """Tokens in a sensitive context."""
    if not text:
        return []
    low = text.lower()
    if not any(c in low for c in _CUES):
        return []
    out = []
    for m in _TOKEN.finditer(text):
        before = text[max(0, m.start() - NEAR) : m.start()].lower()
        if any(c in before for c in _CUES):
            out.append(m.span())
    return out


def added_spans(text: str | None, base: list[tuple[int, int, int]], novelty: Novelty) -> list[tuple[int, int, int]]:
    """Candidates in a sensitive context that do not compress."""
    out = []
    for start, end in candidate_spans(text):
        if not any(s < end and start < e for s, _, e in base) and novelty.reached(text, start, end):
            out.append((start, len(KINDS), end))
    return out


def identifiers(docs: DataFrame, text_col: str = "text", most: int = IDENTIFIERS) -> list[str]:
    """The identifiers in most distinct texts of all documents, at most
    ``most`` of at most 32 characters, without those of candidates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        inside: Counter = Counter()  # texts that hold the word in a candidate

        def out():
            batch = pa.RecordBatch.from_arrays(
                [
                    pa.array(list(counts.keys()), pa.string()), pa.array(list(counts.values()), pa.int64()),
                    pa.array([inside[w] for w in counts], pa.int64()),
                ],
                ["word", "n", "inside"],
            )
            counts.clear()
            inside.clear()
            return batch

        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts.update(set(_IDENTIFIER.findall(text or "")))
                inside.update({w for start, end in candidate_spans(text) for w in _IDENTIFIER.findall(text, start, end)})
                if len(counts) > _FLUSH:
                    yield out()
        yield out()

    texts = docs.select(F.col(text_col).alias("text")).where("text is not null")
    texts = texts.withColumn("h", F.xxhash64("text")).dropDuplicates(["h"]).select("text")
    counted = texts.mapInArrow(run, "word string, n long, inside long").groupBy("word")
    counted = counted.agg(F.sum("n").alias("n"), F.sum("inside").alias("inside"))
    counted = counted.where("n > 1 and 2 * inside < n")
    return [r["word"] for r in topmost(counted, most, F.desc("n"), "word").collect()]


RESULT = "struct<base:array<struct<start:int,k:int,end:int>>,spans:array<struct<start:int,k:int,end:int>>>"


def find(docs: DataFrame, into: str, text_col: str = "text", words: list[str] | None = None) -> DataFrame:
    """``docs`` with a struct column ``into``: ``base`` and ``spans`` (base
    and added), arrays of ``(start, k, end)`` in order; ``k`` numbers
    ``KINDS``, then ``ADDED``. ``words`` is the identifier dictionary (by
    default from the documents)."""
    words = identifiers(docs, text_col) if words is None else words
    shared = docs.sparkSession.sparkContext.broadcast((words, calibrated(docs, words, text_col)))

    @F.pandas_udf(RESULT)
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        novelty = Novelty(*shared.value)
        fields = ("start", "k", "end")
        for texts in batches:
            rows = []
            for text in texts:
                base = base_spans(text)
                spans = sorted(base + added_spans(text, base, novelty))
                rows.append(tuple([dict(zip(fields, x)) for x in part] for part in (base, spans)))
            yield pd.DataFrame(rows, columns=["base", "spans"])

    return docs.withColumn(into, scan(F.col(text_col)))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in (*KINDS, ADDED)])
    parts = F.transform(
        spans, lambda x: F.concat_ws(":", F.get(kinds, x["k"]), x["start"].cast("string"), x["end"].cast("string"))
    )
    return F.array_join(parts, ",")
