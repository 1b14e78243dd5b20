"""Personal data in texts with many matches: offsets and redaction across the
chunks that matches are folded in."""

from __future__ import annotations

import random
import time

import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from trendstats.llm import pii


def redacted(text, spans):
    pos, out = 0, []
    for start, k, end in spans:
        if start >= pos:
            out += [text[pos:start], f"[{pii.KINDS[k].upper()}]"]
        pos = max(pos, end)
    return "".join(out) + text[pos:]


def crowded(n):
    return " ".join(
        (f"é{i}.b@x{i}.com", f"{i % 300}.1.2.3", f"+1 (456) 555-{1000 + i % 9000}", "4111 1111 1111 1111 😀", str(i * 7919))[i % 5] for i in range(n)
    )


@pytest.mark.parametrize("chunk", [1, 3, 256])
def test_offsets_across_chunks(spark, monkeypatch, chunk):
    monkeypatch.setattr(pii, "CHUNK", chunk)
    texts = [crowded(n) for n in (0, 1, 2, 3, 4, 7, 40)] + ([crowded(n) for n in (255, 256, 257, 900)] if chunk > 3 else [])
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", pii.listed(pii.base_spans(F.col("t"))).alias("s")).collect():
        assert r["s"] == brute.pii(r["t"])[1]


def test_redaction_across_chunks(spark, monkeypatch):
    r = random.Random(1)
    rows = []
    for n in (0, 1, 3, 15, 16, 17, 60, 200):
        text = "".join(r.choice("abcdé 😀") for _ in range(6 * n + 10))
        spans = set()
        for _ in range(n):
            at = r.randrange(len(text))
            spans.add((at, r.randrange(4), min(len(text), at + r.choice([1, 2, 5, 40, 300 if r.random() < 0.05 else 3]))))
        rows.append((text, sorted(spans)))
    monkeypatch.setattr(pii, "CHUNK", 16)
    df = spark.createDataFrame(rows, "t string, s array<struct<start:int,k:int,end:int>>")
    for r in df.select("t", "s", pii.redacted(F.col("t"), F.col("s")).alias("o")).collect():
        assert r["o"] == redacted(r["t"], [tuple(x) for x in r["s"]])


def test_time_grows_with_the_matches(spark):
    def seconds(n):
        df = spark.createDataFrame([(" ".join(f"a{i}@x.com {i % 255}.1.2.3" for i in range(n)),)], "t string")
        spans = df.select("t", pii.base_spans(F.col("t")).alias("s"))
        began = time.perf_counter()
        row = spans.select(F.size("s").alias("n"), F.length(pii.redacted(F.col("t"), F.col("s"))).alias("l")).first()
        assert row["n"] == 2 * n and row["l"] == n * len("[EMAIL] [IP] ") - 1
        return time.perf_counter() - began

    seconds(100)  # compiled
    small, large = seconds(2_000), seconds(20_000)
    assert large < 40 * small + 5  # ten times the matches; quadratic would be a hundred
