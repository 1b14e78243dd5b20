"""The adapter's keys and brands."""

from __future__ import annotations

import datetime as dt
import os

from trendstats.sources.tables import trending_from_tables


def test_long_part_keys_stay_apart(spark, tmp_path):
    day = dt.datetime(1996, 1, 1)
    rows = [(1, k, 1, 1, 2.0, 10.0, day) for k in (123456789, 123456780, 5)]
    spark.createDataFrame(
        rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_shipdate timestamp_ntz"
    ).write.parquet(os.path.join(tmp_path, "lineitem.parquet"))
    brands = [(123456789, "p", "Brand#12"), (123456780, "p", "odd"), (5, "p", "Brand#1234567890123")]
    spark.createDataFrame(brands, "p_partkey long, p_name string, p_brand string").write.parquet(os.path.join(tmp_path, "part.parquet"))
    spark.createDataFrame([(1, "s")], "s_suppkey long, s_name string").write.parquet(os.path.join(tmp_path, "supplier.parquet"))
    got = {r.video_id: r.category_id for r in trending_from_tables(spark, str(tmp_path)).collect()}
    assert got == {"v123456789": 12, "v123456780": None, "v5": None}
