"""Benchmark decontamination with one Aho-Corasick automaton.

Words are runs of letters, digits and non-ASCII characters, with A-Z
lower-cased. Every window of ``n`` consecutive words of a benchmark item (or
the whole item when it has fewer) is a pattern of one automaton over word
numbers. A document is normalised and scanned once; hits come back as word
positions and are mapped to code-point offsets of the original text.

Scale: no shuffle; documents stream through Arrow batches and only the text
column goes to Python. The benchmark's size is measured first: its texts are
broadcast in groups of at most ``group_bytes``, one automaton each. A
benchmark beyond one group takes one further pass over the documents per
group, each cut to the shared checkpoint folder (an item longer than a
group still is one group).

Defined cases: null and empty texts have no words and no hits; a null item
text has no window; a null item id counts as the empty string; repeated
items with one id count once; an empty benchmark hits nothing; repeated
document rows each get a result; other columns stay as they are.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendstats.llm.common import cut, spare

WINDOW = 10
GROUP_BYTES = 16 << 20
_WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")
_SPANS = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")
RESULT = "struct<n_words:bigint,runs:array<int>,items:array<string>,spans:string>"


def words_of(text: bytes | None) -> list[bytes]:
    return _WORDS.findall(text.lower()) if text else []


class Matcher:
    """Automaton over the word windows of ``(item_id, text)`` rows."""

    def __init__(self, items: list[tuple[str, bytes]], n: int):
        self.vocabulary: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            for at in range(max(1, len(ids) - n + 1) if ids else 0):
                owners.setdefault(tuple(ids[at : at + n]), set()).add(item)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for window, names in owners.items():
            self.automaton.add_word(window, (len(window), frozenset(names)))
        self.empty = not owners
        if owners:
            self.automaton.make_automaton()

    def scan(self, text: bytes | None) -> tuple[int, list[tuple[int, int]], set[str]]:
        """Number of words, hit word ranges (end exclusive, merged), items."""
        words = words_of(text)
        if self.empty or not words:
            return len(words), [], set()
        get = self.vocabulary.get
        names: set[str] = set()
        ranges: list[tuple[int, int]] = []
        for end, (size, items) in self.automaton.iter(tuple([get(w, 0) for w in words])):
            ranges.append((end - size + 1, end + 1))
            names |= items
        return len(words), merged(ranges), names


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(ranges):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def _offsets(text: bytes, ranges: list[tuple[int, int]]) -> str:
    """Word ranges as ``start:end`` code points of the original text."""
    spans = [m.span() for m in _SPANS.finditer(text.decode("utf-8", "surrogateescape"))]
    return ",".join(f"{spans[lo][0]}:{spans[hi - 1][1]}" for lo, hi in ranges)


_BUILT: dict[tuple[str, int], Matcher] = {}  # the matcher of this worker


def _matcher(items: list[tuple[str, bytes]], n: int) -> Matcher:
    key = (hashlib.sha256(repr(items).encode()).hexdigest(), n)
    if key not in _BUILT:
        _BUILT.clear()  # one automaton in memory at a time
        _BUILT[key] = Matcher(items, n)
    return _BUILT[key]


def _scanner(shared, n: int):
    @F.pandas_udf(RESULT)
    def scan(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        matcher = _matcher(shared.value, n)
        for texts, runs, items in batches:
            rows = []
            for text, before, names in zip(texts, runs, items):
                count, ranges, found = matcher.scan(text)
                old = [] if before is None else list(zip(before[::2], before[1::2]))
                ranges = merged([*old, *ranges]) if len(old) else ranges
                found = sorted(found | set(() if names is None else names))
                flat = [int(x) for r in ranges for x in r]
                rows.append((count, flat, found, _offsets(text, ranges) if ranges else ""))
            yield pd.DataFrame(rows, columns=["n_words", "runs", "items", "spans"])

    return scan


def _groups(benchmark: DataFrame, item_col: str, text_col: str, group_bytes: int):
    """The benchmark's rows in lists of about ``group_bytes`` at most."""
    items = benchmark.where(F.col(text_col).isNotNull()).select(
        F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), F.col(text_col).cast("binary").alias("text")
    )
    size = items.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0)).alias("n")).first()["n"]
    count = max(1, -(-size // group_bytes))
    for g in range(count):
        part = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(count)) == g)
        yield count, sorted((r["item"], bytes(r["text"])) for r in part.toLocalIterator())


def annotate(
    docs: DataFrame,
    benchmark: DataFrame,
    into: str,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    n: int = WINDOW,
    group_bytes: int = GROUP_BYTES,
) -> DataFrame:
    """``docs`` with a struct column ``into``: ``n_words``, ``runs`` (hit
    word ranges, start and end in turn), ``items`` (ids, sorted) and
    ``spans`` (hit code-point ranges of the original text)."""
    out = docs.withColumn(into, F.lit(None).cast(RESULT))
    for count, items in _groups(benchmark, item_col, item_text_col, group_bytes):
        scan = _scanner(docs.sparkSession.sparkContext.broadcast(items), n)
        found = scan(F.col(text_col).cast("binary"), F.col(into)["runs"], F.col(into)["items"])
        out = out.withColumn(into, found)
        out = cut(out) if count > 1 else out
    return out


def n_hit(found: Column) -> Column:
    """Number of hit words from the ``runs`` of a result struct."""
    runs = found["runs"]
    return F.aggregate(
        F.transform(runs, lambda x, i: F.when(i % 2 == 1, x).otherwise(-x).cast("long")),
        F.lit(0).cast("long"),
        lambda a, x: a + x,
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents that hold any benchmark window."""
    into = spare(docs, "__hits")
    found = annotate(docs, benchmark, into, **options)
    return found.where(F.size(F.col(into)["items"]) == 0).select(*[F.col(f"`{c}`") for c in docs.columns])
