"""Built-in column expressions for the projections of the original jobs.

Every function returns a ``Column`` made only of Spark SQL expressions, so it
stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trendstats.schema import WATCH_URL_PREFIX


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def watch_url(video_id: str | Column = "video_id") -> Column:
    """``https://www.youtube.com/watch?v=<id>``."""
    return F.concat(F.lit(WATCH_URL_PREFIX), _col(video_id))


def publish_date_of(publish_time: str | Column = "publish_time") -> Column:
    """Date from the first ten characters (``yyyy-MM-dd``) of a timestamp
    text; null when they are not a date."""
    return F.try_to_date(F.substring(_col(publish_time), 1, 10), "yyyy-MM-dd")


def nonnegative_bigint(text: str | Column) -> Column:
    """Text → bigint; null for non-numbers (the caller rejects negatives)."""
    return _col(text).try_cast("bigint")


def category_label(category_id: str | Column = "category_id", title: str | Column = "category") -> Column:
    """``<id>:<title>``, with ``null`` spelled out for an unknown id."""
    return F.concat(
        _col(category_id).cast("string"), F.lit(":"), F.coalesce(_col(title), F.lit("null"))
    )


def us_date(d: str | Column = "publish_date") -> Column:
    """``MM/dd/yyyy``."""
    return F.date_format(_col(d), "MM/dd/yyyy")


def display_line(with_category: bool = False) -> Column:
    """``title: T (ID)\\tdate: MM/dd/yyyy\\tviews: V\\tlikes: L`` and, for the
    ranked jobs, ``\\tcategory: C`` (the category id)."""
    parts = [
        F.lit("title: "),
        F.col("title"),
        F.lit(" ("),
        F.col("video_id"),
        F.lit(")\tdate: "),
        us_date("publish_date"),
        F.lit("\tviews: "),
        F.col("views").cast("string"),
        F.lit("\tlikes: "),
        F.col("likes").cast("string"),
    ]
    if with_category:
        parts += [F.lit("\tcategory: "), F.col("category_id").cast("string")]
    return F.concat(*parts)


def dated_line() -> Column:
    """``yyyy-MM-dd - <watch url> - title:T``."""
    return F.concat(
        F.col("publish_date").cast("string"),
        F.lit(" - "),
        watch_url("video_id"),
        F.lit(" - title:"),
        F.col("title"),
    )


def ranked_line(rank: str | Column = "rank", line: str | Column = "line") -> Column:
    """``<n>: <line>`` as written by the ranked text files."""
    return F.concat(_col(rank).cast("string"), F.lit(": "), _col(line))


def category_id_of_label(label: str | Column) -> Column:
    """Category id back from an ``<id>:<title>`` label (null if not a number)."""
    return F.trim(F.split_part(_col(label), F.lit(":"), F.lit(1))).try_cast("int")


def prefixed_line(prefix: str | Column, line: str | Column) -> Column:
    """``<prefix>: <line>``, e.g. a category name before a record."""
    return F.concat(_col(prefix), F.lit(": "), _col(line))


def single_line(text: str | Column) -> Column:
    """Every line break (``\\R``) replaced by a space, for one-record-per-line
    text outputs of multi-line input."""
    return F.regexp_replace(_col(text), r"\R", " ")


def record_csv_line(*columns: str) -> Column:
    """The named columns as one CSV-formatted text line."""
    return F.to_csv(F.struct(*[F.col(c).cast("string").alias(c) for c in columns]))
