from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tests.fixtures import GOLDEN_CSV, category_json  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = os.environ.get("TRENDSTATS_ORACLE_SF", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[*]")
        .appName("trendstats-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def workdir():
    return tempfile.mkdtemp(prefix="trendstats-test-")


@pytest.fixture(scope="session")
def golden_csv(workdir):
    path = os.path.join(workdir, "USvideos.csv")
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(GOLDEN_CSV)
    return path


@pytest.fixture(scope="session")
def categories_json(workdir):
    path = os.path.join(workdir, "US_category_id.json")
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(category_json())
    return path


@pytest.fixture(scope="session")
def cats(spark, categories_json):
    from trendstats.sources import read_categories

    return read_categories(spark, categories_json).cache()


@pytest.fixture(scope="session")
def records(spark, golden_csv):
    from trendstats.sources import read_trending

    return read_trending(spark, golden_csv).cache()
