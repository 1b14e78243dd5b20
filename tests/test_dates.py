"""Range cut-offs: as_of on the last day of every month and the 1st/29th edge cases."""

from __future__ import annotations

import calendar
import datetime as dt

import pytest
from pyspark.sql import functions as F

from trendstats.functions.dates import normalise_range, range_cutoff


def months_back(d: dt.date, n: int) -> dt.date:
    y, m = divmod(d.year * 12 + (d.month - 1) - n, 12)
    m += 1
    last = calendar.monthrange(y, m)[1]
    return dt.date(y, m, min(d.day, last))  # the day is clamped, never moved to the month end


AS_OFS = (
    [dt.date(2018, m, calendar.monthrange(2018, m)[1]) for m in range(1, 13)]
    + [dt.date(2018, m, 15) for m in range(1, 13)]
    + [dt.date(2020, 2, 29), dt.date(2018, 1, 1), dt.date(2018, 3, 31)]
)


def test_cutoffs(spark):
    exprs = []
    for i, d in enumerate(AS_OFS):
        for name in ("last-week", "last-month", "last-6-Months", "last-year"):
            exprs.append(range_cutoff(name, d).alias(f"{name}|{i}"))
    row = spark.range(1).select(*exprs).first().asDict()
    for key, got in row.items():
        name, i = key.split("|")
        d = AS_OFS[int(i)]
        want = d - dt.timedelta(days=7) if name == "last-week" else months_back(
            d, {"last-month": 1, "last-6-Months": 6, "last-year": 12}[name]
        )
        assert got == want, (name, d, got, want)


def test_known_clamps(spark):
    row = spark.range(1).select(
        range_cutoff("last-month", "2018-03-31").alias("a"),
        range_cutoff("last-6-Months", "1998-08-31").alias("b"),
        range_cutoff("last-year", "2020-02-29").alias("c"),
    ).first()
    assert row.a == dt.date(2018, 2, 28)
    assert row.b == dt.date(1998, 2, 28)
    assert row.c == dt.date(2019, 2, 28)


def test_no_filter_and_names():
    assert range_cutoff("no-date-filter", "2018-01-01") is None
    assert normalise_range("lastWeek") == "last-week"
    with pytest.raises(ValueError):
        normalise_range("last-decade")


def test_inclusive_lower_bound_only(spark):
    from trendstats.operators import published_since

    df = spark.range(1).select(F.explode(F.array(*[F.lit(dt.date(2018, 3, d)) for d in (23, 24, 31)])).alias("publish_date"))
    got = sorted(r.publish_date.day for r in published_since(df, "last-week", "2018-03-31").collect())
    assert got == [24, 31]
