"""Trending-snapshot source: CSV files → clean record schema.

Two reader modes:

* ``mode="csv"`` (default): Spark's CSV reader (quote-aware, doubled quotes
  escape a quote, header skipped). A row whose width is not 16 is marked
  malformed through the corrupt-record column. Splittable unless
  ``multi_line=True`` (needed only for quoted fields with real newlines).
* ``mode="line"``: line-exact semantics of the original parser: read text
  lines, split on a comma followed by an even number of quotes, drop
  trailing empty tokens, delete every quote. A row is malformed unless it
  has exactly 16 tokens. Use it for row-for-row agreement with the original.

Both keep *every* row and add ``_malformed`` (wrong width or no video id);
``valid_records`` and ``rejected_records`` split them per query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendstats.functions.columns import nonnegative_bigint, publish_date_of
from trendstats.schema import (
    HEADER_LINE,
    METRICS,
    RAW_COLUMNS,
    TRENDING_DATE_FORMAT,
    raw_schema,
)

_CORRUPT = "_corrupt"


def read_raw_csv(spark: SparkSession, path: str | list[str], multi_line: bool = False) -> DataFrame:
    """16 string columns plus ``_malformed`` from Spark's CSV reader."""
    raw = (
        spark.read.schema(raw_schema(_CORRUPT))
        .option("header", True)
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _CORRUPT)
        # Without this a query that reads few columns would let malformed
        # rows through (the parser then only checks the columns it needs).
        .option("columnPruning", False)
        .option("multiLine", multi_line)
        .csv(path)
    )
    return raw.select(
        *[F.col(c) for c in RAW_COLUMNS],
        # Malformed = wrong width or no video id. Reading video_id here also
        # keeps the reader from seeing a plan that needs only the corrupt
        # column, which it refuses.
        (F.col(_CORRUPT).isNotNull() | F.col("video_id").isNull()).alias("_malformed"),
    )


def java_token_count(tokens: Column) -> Column:
    """Number of tokens once trailing empty ones are dropped (what a
    one-argument ``String.split`` returns)."""
    last = F.array_max(F.transform(tokens, lambda t, i: F.when(t != "", i + 1).otherwise(0)))
    # without a trailing empty token it is the array's size
    return F.when(F.element_at(tokens, -1) != "", F.size(tokens)).otherwise(F.coalesce(last, F.lit(0)))


# What splitting commas become, and what a line's own NUL becomes before
# that, so that no line holds the mark.
_MARK, _NUL, _ESCAPED = "\u0000m", "\u0000", "\u0000e"


def quote_aware_split(line: str | Column) -> Column:
    """Split a line on every comma followed by an even number of quotes up
    to the end of the line, keeping empty fields (quotes are not removed).

    Same result as splitting on the pattern ``QUOTE_AWARE_COMMA`` with limit
    -1, in time linear in the line length. Cut at quotes, the k-th piece holds the
    commas that have exactly k quotes before them; such a comma splits when
    k has the parity of the line's quote count. Those pieces get their
    commas replaced by a mark, the pieces are joined back, and the line is
    split once at the marks.
    """
    line = F.col(line) if isinstance(line, str) else line
    pieces = F.split(F.replace(line, F.lit(_NUL), F.lit(_ESCAPED)), '"', -1)
    parity = (F.size(pieces) - 1) % 2
    marked = F.array_join(
        F.transform(
            pieces,
            lambda piece, k: F.when(k % 2 == parity, F.replace(piece, F.lit(","), F.lit(_MARK))).otherwise(piece),
        ),
        '"',
    )
    fields = F.split(marked, _MARK, -1)
    plain = F.transform(fields, lambda f: F.replace(f, F.lit(_ESCAPED), F.lit(_NUL)))
    simple = F.when(F.instr(line, '"') == 0, F.split(line, ",", -1))  # most lines: every comma splits
    return simple.when(F.instr(line, _NUL) > 0, plain).otherwise(fields)


def read_raw_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """16 string columns plus ``_malformed`` with the line-exact split."""
    lines = spark.read.text(path).where(F.col("value") != F.lit(HEADER_LINE))
    with_tokens = lines.select(quote_aware_split("value").alias("_t"))
    fields = [
        F.nullif(F.replace(F.get(F.col("_t"), i), F.lit('"'), F.lit("")), F.lit("")).alias(name)
        for i, name in enumerate(RAW_COLUMNS)
    ]
    out = with_tokens.select(*fields, (java_token_count(F.col("_t")) != len(RAW_COLUMNS)).alias("_width_bad"))
    return out.select(*RAW_COLUMNS, (F.col("_width_bad") | F.col("video_id").isNull()).alias("_malformed"))


def typed_records(raw: DataFrame, trending_date_format: str = TRENDING_DATE_FORMAT) -> DataFrame:
    """Cast the 16 text fields; nothing is dropped here.

    Record schema first (see ``trendstats.schema``), then the remaining CSV
    fields and ``_malformed``.
    """
    return raw.select(
        F.col("video_id"),
        F.try_to_date(F.col("trending_date"), trending_date_format).alias("trending_date"),
        F.col("title"),
        F.col("channel_title"),
        F.col("category_id").try_cast("int").alias("category_id"),
        publish_date_of("publish_time").alias("publish_date"),
        *[nonnegative_bigint(m).alias(m) for m in METRICS],
        F.col("trending_date").alias("trending_date_text"),
        F.col("publish_time"),
        F.col("tags"),
        nonnegative_bigint("comment_count").alias("comment_count"),
        F.col("thumbnail_link"),
        F.col("comments_disabled").try_cast("boolean").alias("comments_disabled"),
        F.col("ratings_disabled").try_cast("boolean").alias("ratings_disabled"),
        F.col("video_error_or_removed").try_cast("boolean").alias("video_error_or_removed"),
        F.col("description"),
        F.col("_malformed"),
    )


def read_trending(
    spark: SparkSession,
    path: str | list[str],
    mode: str = "csv",
    multi_line: bool = False,
    trending_date_format: str = TRENDING_DATE_FORMAT,
) -> DataFrame:
    """Read trending CSV files (a file, a directory or a glob)."""
    if mode == "csv":
        raw = read_raw_csv(spark, path, multi_line=multi_line)
    elif mode == "line":
        raw = read_raw_lines(spark, path)
    else:
        raise ValueError(f"mode must be 'csv' or 'line', got {mode!r}")
    return typed_records(raw, trending_date_format)


def usable(
    df: DataFrame,
    metrics: tuple[str, ...] | list[str] = (),
    need_date: bool = False,
    display: bool = False,
) -> Column:
    """Boolean column (null counts as no): is the row usable for this query?

    Always: right width, a video id, a numeric category. Then every metric
    asked for is a non-negative integer, the publish date parses when
    ``need_date``, and title/views/likes/date are present when ``display``.
    """
    cond = F.col("video_id").isNotNull() & F.col("category_id").isNotNull()
    if "_malformed" in df.columns:
        cond = cond & ~F.col("_malformed")
    needed = list(metrics)
    if display:
        needed += [m for m in ("views", "likes") if m not in needed]
        need_date = True
        cond = cond & F.col("title").isNotNull()
    for m in needed:
        cond = cond & F.col(m).isNotNull() & (F.col(m) >= 0)
    if need_date:
        cond = cond & F.col("publish_date").isNotNull()
    return cond


def validity(df: DataFrame, metrics=(), need_date: bool = False, display: bool = False) -> Column:
    """``usable`` as true or false, never null."""
    return F.coalesce(usable(df, metrics, need_date, display), F.lit(False))


def valid_records(df: DataFrame, metrics=(), need_date: bool = False, display: bool = False) -> DataFrame:
    """The usable rows. The tests stay a plain conjunction (``where`` drops
    null), which the planner splits and pushes down to the scan."""
    return df.where(usable(df, metrics, need_date, display))


def reject_reason(df: DataFrame, metrics=(), need_date: bool = False, display: bool = False) -> tuple[Column, list[str]]:
    """The first test of ``usable`` that a row fails, null for a usable row,
    and the names of the tests."""
    reasons = []
    if "_malformed" in df.columns:
        reasons.append((F.col("_malformed"), "malformed"))
    reasons += [
        (F.col("video_id").isNull(), "video_id"),
        (F.col("category_id").isNull(), "category_id"),
    ]
    needed = list(metrics)
    if display:
        needed += [m for m in ("views", "likes") if m not in needed]
        reasons.append((F.col("title").isNull(), "title"))
        need_date = True
    for m in needed:
        reasons.append((F.col(m).isNull() | (F.col(m) < 0), m))
    if need_date:
        reasons.append((F.col("publish_date").isNull(), "publish_date"))
    reason = F.lit(None).cast("string")
    for cond, name in reversed(reasons):
        reason = F.when(cond, F.lit(name)).otherwise(reason)
    return reason, [name for _, name in reasons]


def rejected_records(df: DataFrame, metrics=(), need_date: bool = False, display: bool = False) -> DataFrame:
    """Complement of ``valid_records`` with the first failing ``reason``."""
    reason, _ = reject_reason(df, metrics, need_date, display)
    return df.where(~validity(df, metrics, need_date, display)).withColumn("reason", reason)


def as_field_map(df: DataFrame, columns: tuple[str, ...] | list[str] | None = None) -> DataFrame:
    """One ``map<string,string>`` column ``fields`` of the named columns (all
    but ``_malformed`` by default), each value cast to text."""
    cols = [c for c in (columns or df.columns) if c != "_malformed"]
    pairs = [e for c in cols for e in (F.lit(c), F.col(c).cast("string"))]
    return df.select(F.create_map(*pairs).alias("fields"))


def read_clean_table(spark: SparkSession, path: str) -> DataFrame:
    """Read a table written by ``sinks.write_clean_table``."""
    return spark.read.parquet(path)
