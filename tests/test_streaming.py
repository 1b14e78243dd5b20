"""The streaming totals equal the batch totals, file by file."""

from __future__ import annotations

import os

from tests.fixtures import GOLDEN_CSV
from trendstats.streaming import category_totals, start_category_totals


def rows(df):
    return sorted(tuple(r) for r in df.select("category_id", "n_records", "views", "likes", "dislikes").collect())


def test_stream_matches_batch(spark, records, workdir):
    incoming = os.path.join(workdir, "incoming")
    os.makedirs(incoming)
    header, *body = GOLDEN_CSV.splitlines()
    half = len(body) // 2
    out = os.path.join(workdir, "totals")
    ckpt = os.path.join(workdir, "totals_ckpt")

    with open(os.path.join(incoming, "day1.csv"), "w") as f:
        f.write("\n".join([header] + body[:half]) + "\n")
    q = start_category_totals(spark, incoming, out, ckpt, available_now=True)
    q.awaitTermination(120)
    first = rows(spark.read.parquet(out))
    assert first and all(r[1] > 0 for r in first)

    with open(os.path.join(incoming, "day2.csv"), "w") as f:
        f.write("\n".join([header] + body[half:]) + "\n")
    q = start_category_totals(spark, incoming, out, ckpt, available_now=True)
    q.awaitTermination(120)
    assert rows(spark.read.parquet(out)) == rows(category_totals(records))


def test_stream_totals_cli(spark, records, workdir):
    from trendstats.__main__ import main

    incoming = os.path.join(workdir, "incoming_cli")
    os.makedirs(incoming)
    with open(os.path.join(incoming, "day1.csv"), "w") as f:
        f.write(GOLDEN_CSV)
    out = os.path.join(workdir, "totals_cli")
    args = ["stream-totals", incoming, out, os.path.join(workdir, "totals_cli_ckpt"), "--once"]
    assert main(args, stop=False) == 0
    assert rows(spark.read.parquet(out)) == rows(category_totals(records))
