"""Hard negatives against all pairs."""

from __future__ import annotations

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.llm import brute
from trendstats.llm import negatives
from trendstats.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<double>, label int, id string, part int, score string"


def mined(spark, rows, parts=3, **options):
    df = spark.createDataFrame([(i, v, label, "a", 1, "b") for i, label, v in rows], SCHEMA).repartition(parts)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    got = negatives.mine(df, F.col("vec_id") % 100 == 0, label=label, **options)
    return sorted(map(repr, map(tuple, got.collect())))


def plain(rows, **options):
    return sorted(map(repr, brute.hard_negatives(rows, **options)))


def random_rows(seed, n=400, levels=3, dims=6, labels=3):
    """Few levels: many ties; some rows cannot take part."""
    r = random.Random(seed)
    rows = [(i, r.randrange(labels), [r.randrange(-levels, levels + 1) / 256 for _ in range(dims)]) for i in range(n)]
    bad = [(1001, None, [1.0] * dims), (1002, 1, None), (1003, 1, [None] * dims), (1100, 1, [float("nan")] * dims), (1200, 2, [float("inf")] * dims)]
    return rows + bad + [(None, 1, [2 / 256] * dims), (1300, 2, []), (1400, 1, [3 / 256] * (dims + 2)), (1500, 9, [1.0] * dims)]


@pytest.mark.parametrize("seed", range(3))
def test_ties_and_bad_rows(spark, seed):
    rows = random_rows(seed)
    assert mined(spark, rows) == plain(rows)


def test_many_parts_and_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(negatives, "PART_BYTES", 6 * 8 * 60)
    rows = random_rows(7)
    assert mined(spark, rows, negatives=3, positives=3) == plain(rows, k=3)


def test_repeated_rows_count_and_huge_components_stay_whole(spark):
    rows = random_rows(5, 60) + random_rows(5, 60)[:50]
    rows += [(2000, 1, [3e9, -1.5, 0.25, 1e7, 2.0, 7.0]), (2001, 1, [2.9e9, 1.0, 1.0, 1e7, 2.0, 7.0]), (2002, 2, [2.8e9, 1.0, 1.0, 1e7, 2.0, 7.0])]
    got = mined(spark, rows)
    want = [r for r in brute.hard_negatives(rows)]
    top = (1 << 63) - 1
    assert any(abs(r[4]) >= 1 << 53 for r in want)
    clipped = sorted(repr((*r[:4], min(r[4], top), min(r[5], top))) for r in want)
    assert got == clipped


def test_a_hot_label(spark):
    r = random.Random(3)
    rows = [(i, 1 if i % 3 else r.randrange(5), [r.gauss(0, 1) for _ in range(8)]) for i in range(900)]
    assert mined(spark, rows) == plain(rows)


def test_slots_hold_what_overlapping_windows_need():
    assert negatives.matrix(pa.array([[1.0, 2.0], [], [3.0]])).tolist() == [[1.0, 2.0], [0.0, 0.0], [3.0, 0.0]]


def test_the_query_on_awkward_rows(spark, edge_dir):
    rows = [(r["vec_id"], r["label"], r["embedding"]) for r in spark.read.parquet(f"{edge_dir}/embeddings.parquet").collect()]
    assert sorted(map(repr, map(tuple, QUERIES["op12_hard_negatives"](spark, edge_dir).collect()))) == plain(rows)


def test_the_query_on_a_small_table_and_an_empty_one(spark, tmp_path):
    rows = [(r["vec_id"], r["label"], r["embedding"]) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    got = QUERIES["op12_hard_negatives"](spark, SF_SMALL)
    assert [t for _, t in got.dtypes] == ["bigint", "bigint", "int", "bigint", "bigint", "bigint"]
    assert sorted(map(repr, map(tuple, got.collect()))) == plain(rows)
    spark.createDataFrame([], "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    assert QUERIES["op12_hard_negatives"](spark, str(tmp_path)).count() == 0
