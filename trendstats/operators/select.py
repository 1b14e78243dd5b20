"""Row filters on publish date and display readiness."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendstats.functions.dates import range_cutoff
from trendstats.sources.trending import valid_records


def valid_publish_date(df: DataFrame, min_year: int | None = None) -> DataFrame:
    """Rows with a publish date (optionally from ``min_year`` on)."""
    cond = F.col("publish_date").isNotNull()
    if min_year is not None:
        cond = cond & (F.col("publish_date") >= F.lit(dt.date(min_year, 1, 1)))
    return df.where(cond)


def published_in(df: DataFrame, year: int) -> DataFrame:
    """Published in ``year``, written as a half-open date range so that it
    can be pushed down to a scan."""
    return df.where(
        (F.col("publish_date") >= F.lit(dt.date(year, 1, 1)))
        & (F.col("publish_date") < F.lit(dt.date(year + 1, 1, 1)))
    )


def published_since(df: DataFrame, range_name: str, as_of: str | dt.date | None = None) -> DataFrame:
    """Published on or after the range's cut-off (no upper bound)."""
    cutoff = range_cutoff(range_name, as_of)
    if cutoff is None:
        return df.where(F.col("publish_date").isNotNull())
    return df.where(F.col("publish_date") >= cutoff)


def display_ready(df: DataFrame) -> DataFrame:
    """Rows that can be shown as a display line: category, video id, title,
    a parseable publish date, and usable views and likes."""
    return valid_records(df, display=True)
