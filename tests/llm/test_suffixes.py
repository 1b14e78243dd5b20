"""Repeated passages against all strings of the corpus, and the parts of the
sort on their own."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.llm import brute
from trendstats.llm import suffixes
from trendstats.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, data string, block int, `n_bytes` string"


def found(spark, texts, parts=4, **options):
    rows = [(i, t, "x", 1, "y") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    got = suffixes.without_repeats(docs, **options).select(
        "id", "n_bytes", F.col("n_bytes") - F.length("kept"), F.size("spans"), F.sha2("kept", 256)
    )
    return [tuple(r)[1:] for r in sorted(got.collect(), key=lambda r: r[0])]


def random_texts(seed, n=40, letters="abc é"):
    """Texts that share pieces of 150 to 700 characters at random places."""
    r = random.Random(seed)
    word = lambda k: "".join(r.choice(letters) for _ in range(k))
    pieces = [word(r.choice([150, 199, 200, 201, 230, 257, 330, 700])) for _ in range(8)]
    texts = [None, "", "a" * 199, "a" * 450, "b" * 200, "b" * 200, pieces[0] * 3]
    for _ in range(n):
        text = "".join(r.choice(pieces) if r.random() < 0.4 else word(r.randrange(120)) for _ in range(r.randrange(8)))
        if text and r.random() < 0.5:
            at = r.randrange(len(text))
            text = text[:at] + r.choice(letters) + text[at + 1 :]
        texts.append(text)
    return texts + texts[-3:]


def test_the_cover_covers_every_difference():
    for size in (3, 4, 5, 6, 8):
        period, cover = suffixes.difference_cover(size)
        assert suffixes.covers(period, cover) and len(cover) == size
    with pytest.raises(ValueError):
        suffixes.difference_cover(7)  # no such set of seven


def test_fingerprints_do_not_depend_on_the_place(monkeypatch):
    monkeypatch.setattr(suffixes, "STEP", 64)
    data = np.frombuffer(bytes(random.Random(1).choices(range(3), k=500)) * 2, dtype=np.uint8)
    at = np.arange(0, 490)
    first, again = suffixes.fingerprints(data, at, 300), suffixes.fingerprints(data, at + 500, 10)
    assert (suffixes.fingerprints(data, at, 10) == again).all()
    assert len(set(first.tolist())) == 490


def test_sets_of_keys_come_back():
    values = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 5_000, dtype=np.uint64))
    assert (suffixes._unpack(suffixes._pack(values), len(values)) == values).all()


@pytest.mark.parametrize("seed", range(4))
def test_random_texts(spark, seed):
    texts = random_texts(seed)
    assert found(spark, texts) == brute.repeats(texts)


def test_many_blocks_and_buckets(spark):
    texts = random_texts(9, 60)
    assert found(spark, texts, parts=6, block_bytes=2_000, bucket_keys=64) == brute.repeats(texts)


def test_runs_and_periods(spark):
    texts = ["ab" * 3_000, "a" * 5_000, ("x" * 250 + "y") * 40, "zab" * 100]
    assert found(spark, texts) == brute.repeats(texts)


def test_the_query_on_a_small_table_and_awkward_rows(spark, edge_dir):
    for folder in (SF_SMALL, edge_dir):
        docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
        want = sorted(repr((d["doc_id"], *r)) for d, r in zip(docs, brute.repeats([d["text"] for d in docs])))
        assert sorted(repr(tuple(r)) for r in QUERIES["op13_suffix_dedup"](spark, folder).collect()) == want


def test_short_strings_are_refused(spark):
    with pytest.raises(ValueError):
        suffixes.without_repeats(spark.createDataFrame([], SCHEMA), least=suffixes.PERIOD - 1)
