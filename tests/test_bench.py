"""bench.py prints exactly one JSON line with the expected fields."""

from __future__ import annotations

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2",
               BENCH_QUERIES="topk_videos_views,sum_views_by_category,records_last_year")
    out = subprocess.run([sys.executable, "bench.py"], cwd=ROOT, env=env, capture_output=True, text=True,
                         timeout=600, check=True).stdout
    lines = [line for line in out.splitlines() if line.strip()]
    assert len(lines) == 1
    doc = json.loads(lines[0])
    assert doc["unit"] == "sec" and doc["sf"] == 0.001
    assert set(doc["queries"]) == {"topk_videos_views", "sum_views_by_category", "records_last_year"}
    assert abs(doc["value"] - sum(doc["queries"].values())) < 0.01
