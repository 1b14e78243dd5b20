"""Every registered query against its DuckDB SQL (sf0.01 by default; set
TRENDSTATS_ORACLE_SF to another folder for a bigger run)."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from tests.conftest import SF_ORACLE
from tools.oracle_check import duck_session, frame_hash, type_diffs

QUERIES = E.QUERIES
NAMES = sorted(set(QUERIES) | set(E.oracle_sql()))


@pytest.fixture(scope="module")
def duck():
    return duck_session(SF_ORACLE)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_ORACLE)
    rows = [tuple(r) for r in df.collect()]
    rel = duck.sql(E.oracle_sql()[name])
    want = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert not type_diffs(df, rel)
    assert len(rows) == len(want)
    assert rows  # an empty result would prove nothing
    assert frame_hash(rows, df.columns) == frame_hash(want, list(rel.columns))


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "rank" in df.columns
