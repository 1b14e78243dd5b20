"""DuckDB SQL equivalents of ``plans.catalog.QUERIES`` (the correctness
oracle). Tables ``lineitem part supplier nation`` are views in the oracle
session. Types are cast so both sides agree: counts, sums and ranks bigint,
ids int, cut-offs date.
"""

from __future__ import annotations

from trendstats.plans import catalog as C
from trendstats.schema import WATCH_URL_PREFIX


def _ids(ids) -> str:
    return ", ".join(str(int(i)) for i in ids)


FOCUS = _ids(C.FOCUS)
AS_OF = f"DATE '{C.AS_OF.isoformat()}'"

TRENDING = f"""trending AS (
  SELECT concat('v', CAST(l.l_partkey AS VARCHAR)) AS video_id,
         CAST(l.l_shipdate AS DATE) AS trending_date,
         p.p_name AS title,
         s.s_name AS channel_title,
         TRY_CAST(substring(p.p_brand, 7) AS INTEGER) AS category_id,
         DATE '1995-01-01' + CAST(l.l_partkey % 2000 AS INTEGER) AS publish_date,
         CAST(floor(l.l_extendedprice) AS BIGINT) AS views,
         CAST(floor(l.l_quantity) AS BIGINT) AS likes,
         CAST(l.l_linenumber AS BIGINT) AS dislikes
  FROM lineitem l
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
)"""

def _dirty(csv: bool) -> str:
    """The records that the dirty lines hold, by the same rule; a quoted
    quote stays in CSV mode and is deleted in line mode."""
    say = "'say \"' || title || '\"'" if csv else "'say ' || title"
    return f"""dirty AS (
  SELECT 'v' || l.l_partkey AS video_id, CAST(l.l_shipdate AS DATE) AS trending_date,
         CASE k WHEN 2 THEN title || ', with comma' WHEN 6 THEN NULL WHEN 7 THEN {say} ELSE title END AS title,
         channel_title, CASE WHEN k <> 8 THEN category_id END AS category_id,
         CASE WHEN k <> 5 THEN publish_date END AS publish_date,
         CASE WHEN k <> 3 THEN views END AS views, CASE WHEN k = 4 THEN -5 ELSE likes END AS likes, dislikes,
         k IN (0, 1) AS malformed, k
  FROM (SELECT l_orderkey % {C.DIRT} AS k, l_partkey, l_shipdate, p_name AS title, s_name AS channel_title,
               TRY_CAST(substring(p_brand, 7) AS INTEGER) AS category_id,
               DATE '1995-01-01' + CAST(l_partkey % 2000 AS INTEGER) AS publish_date,
               CAST(floor(l_extendedprice) AS BIGINT) AS views, CAST(floor(l_quantity) AS BIGINT) AS likes,
               CAST(l_linenumber AS BIGINT) AS dislikes
        FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey) l
)"""


CATS = """cats AS (SELECT CAST(n_nationkey AS INTEGER) AS category_id, n_name AS title FROM nation)"""

VALID = """valid AS (SELECT * FROM trending WHERE video_id IS NOT NULL AND category_id IS NOT NULL)"""

VIDEOS = f"""videos AS (
  SELECT r.video_id, r.title, r.category_id, c.title AS category, r.publish_date, r.trending_date,
         r.channel_title, r.views, r.likes, r.dislikes, '{WATCH_URL_PREFIX}' || r.video_id AS url
  FROM (
    SELECT video_id, title, category_id, publish_date, trending_date, channel_title,
           CAST(sum(views) OVER (PARTITION BY video_id) AS BIGINT) AS views,
           CAST(sum(likes) OVER (PARTITION BY video_id) AS BIGINT) AS likes,
           CAST(sum(dislikes) OVER (PARTITION BY video_id) AS BIGINT) AS dislikes,
           row_number() OVER (PARTITION BY video_id ORDER BY trending_date ASC NULLS LAST,
             title ASC NULLS FIRST, channel_title ASC NULLS FIRST, category_id ASC NULLS FIRST,
             publish_date ASC NULLS FIRST) AS rn
    FROM trending
    WHERE video_id IS NOT NULL AND category_id IS NOT NULL AND publish_date IS NOT NULL
      AND views >= 0 AND likes >= 0 AND dislikes >= 0
  ) r LEFT JOIN cats c ON r.category_id = c.category_id
  WHERE r.rn = 1
)"""

def _videos_of(table: str) -> str:
    return VIDEOS.replace("FROM trending", f"FROM {table} WHERE NOT malformed").replace(
        "malformed\n    WHERE video_id", "malformed\n    AND video_id"
    )


VIDEO_COLS = "video_id, title, category_id, category, publish_date, trending_date, channel_title, views, likes, dislikes, url"

TAB = "chr(9)"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _selection(name: str, ids) -> str:
    rows = ", ".join(f"({pos}, {int(i)})" for pos, i in enumerate(ids, start=1))
    return f"{name} AS (SELECT CAST(pos AS BIGINT) AS pos, CAST(category_id AS INTEGER) AS category_id FROM (VALUES {rows}) t(pos, category_id))"


def _display_line(with_category: bool) -> str:
    s = (
        f"'title: ' || title || ' (' || video_id || ')' || {TAB} || 'date: ' || strftime(publish_date, '%m/%d/%Y')"
        f" || {TAB} || 'views: ' || CAST(views AS VARCHAR) || {TAB} || 'likes: ' || CAST(likes AS VARCHAR)"
    )
    if with_category:
        s += f" || {TAB} || 'category: ' || CAST(category_id AS VARCHAR)"
    return s


DISPLAY_READY = "title IS NOT NULL AND publish_date IS NOT NULL AND views >= 0 AND likes >= 0"

RECORD_TIEBREAK = ("video_id", "trending_date", "title", "channel_title", "publish_date", "views", "likes", "dislikes")


def _topk_by_category(metric: str) -> str:
    return _with(TRENDING, CATS, VIDEOS) + f"""
SELECT {VIDEO_COLS}, rank FROM (
  SELECT v.*, CAST(row_number() OVER (PARTITION BY category_id ORDER BY {metric} DESC, video_id ASC) AS BIGINT) AS rank
  FROM videos v WHERE category_id IN ({FOCUS})
) WHERE rank <= {C.K_PER_CATEGORY}"""


def _topk(metric: str, year: int | None = None) -> str:
    where = f"category_id IN ({FOCUS})"
    if year is not None:
        where += f" AND publish_date >= DATE '{year}-01-01' AND publish_date < DATE '{year + 1}-01-01'"
    return _with(TRENDING, CATS, VIDEOS) + f"""
SELECT {VIDEO_COLS}, rank FROM (
  SELECT v.*, CAST(row_number() OVER (ORDER BY {metric} DESC, video_id ASC) AS BIGINT) AS rank
  FROM videos v WHERE {where}
) WHERE rank <= {C.K_OVERALL}"""


def _topk_records(metric: str) -> str:
    order = ", ".join([f"{metric} DESC"] + [f"{c} ASC NULLS FIRST" for c in RECORD_TIEBREAK if c != metric])
    return _with(TRENDING, VALID) + f"""
SELECT category_id, rank, {metric}, line FROM (
  SELECT category_id, {metric}, {_display_line(True)} AS line,
         CAST(row_number() OVER (PARTITION BY category_id ORDER BY {order}) AS BIGINT) AS rank
  FROM valid WHERE category_id IN ({FOCUS}) AND {DISPLAY_READY}
) WHERE rank <= {C.K_PER_CATEGORY}"""


_CUTOFF = {
    "last-week": f"CAST({AS_OF} - INTERVAL 7 DAY AS DATE)",
    "last-month": f"CAST({AS_OF} - INTERVAL 1 MONTH AS DATE)",
    "last-6-Months": f"CAST({AS_OF} - INTERVAL 6 MONTH AS DATE)",
    "last-year": f"CAST({AS_OF} - INTERVAL 12 MONTH AS DATE)",
    "no-date-filter": None,
}


def _range_where(range_name: str) -> str:
    cutoff = _CUTOFF[range_name]
    where = f"category_id IN ({FOCUS}) AND publish_date IS NOT NULL"
    if cutoff:
        where += f" AND publish_date >= {cutoff}"
    return where


def _records_in_range(range_name: str) -> str:
    line = f"CAST(publish_date AS VARCHAR) || ' - {WATCH_URL_PREFIX}' || video_id || ' - title:' || title"
    return _with(TRENDING, VALID) + f"""
SELECT category_id, rank, publish_date, line FROM (
  SELECT category_id, publish_date, line,
         CAST(row_number() OVER (PARTITION BY category_id ORDER BY publish_date, line) AS BIGINT) AS rank
  FROM (SELECT category_id, publish_date, {line} AS line FROM valid WHERE {_range_where(range_name)})
)"""


def _sum_by_category(metrics) -> str:
    sums = ", ".join(f"CAST(sum(t.{m}) AS BIGINT) AS {m}" for m in metrics)
    ok = " AND ".join(f"t.{m} >= 0" for m in metrics)
    return _with(TRENDING, CATS, VALID) + f"""
SELECT t.category_id, c.title AS category, {sums}
FROM valid t LEFT JOIN cats c ON t.category_id = c.category_id
WHERE t.category_id IN ({FOCUS}) AND {ok}
GROUP BY t.category_id, c.title"""


_FIELD_MAP = " UNION ALL ".join(
    f"SELECT '{c}' AS key, CAST({c} AS VARCHAR) AS value FROM trending"
    for c in ("video_id", "trending_date", "title", "channel_title", "category_id", "publish_date", "views", "likes", "dislikes")
)


ORACLE: dict[str, str] = {
    "rollup_videos": _with(TRENDING, CATS, VIDEOS) + f"SELECT {VIDEO_COLS} FROM videos",
    "list_categories": _with(CATS) + "SELECT category_id, title FROM cats",
    "selected_categories": _with(CATS, _selection("sel", C.CHOSEN_WITH_UNKNOWN))
    + """SELECT CAST(row_number() OVER (ORDER BY s.pos) AS BIGINT) AS position, s.category_id, c.title
FROM sel s JOIN cats c ON s.category_id = c.category_id""",
    "unknown_categories": _with(CATS, _selection("sel", C.CHOSEN_WITH_UNKNOWN))
    + "SELECT s.category_id FROM sel s WHERE s.category_id NOT IN (SELECT category_id FROM cats)",
    "with_category": _with(TRENDING, CATS, VALID)
    + """SELECT t.video_id, t.trending_date, t.title, t.channel_title, t.category_id, t.publish_date,
       t.views, t.likes, t.dislikes, c.title AS category
FROM valid t LEFT JOIN cats c ON t.category_id = c.category_id""",
    "count_videos_by_category": _with(TRENDING, CATS, VIDEOS)
    + """SELECT c.category_id, c.title AS category, CAST(coalesce(n.n_videos, 0) AS BIGINT) AS n_videos
FROM cats c LEFT JOIN (SELECT category_id, count(*) AS n_videos FROM videos GROUP BY category_id) n
  ON c.category_id = n.category_id""",
    "filter_videos_by_category": _with(TRENDING, CATS, VIDEOS)
    + f"SELECT {VIDEO_COLS} FROM videos WHERE category_id IN ({FOCUS})",
    "topk_videos_by_category_views": _topk_by_category("views"),
    "topk_videos_by_category_likes": _topk_by_category("likes"),
    "topk_videos_by_category_dislikes": _topk_by_category("dislikes"),
    "topk_videos_views": _topk("views"),
    "topk_videos_likes": _topk("likes"),
    "topk_videos_dislikes": _topk("dislikes"),
    "topk_videos_views_year": _topk("views", C.YEAR),
    "topk_videos_likes_year": _topk("likes", C.YEAR),
    "topk_videos_dislikes_year": _topk("dislikes", C.YEAR),
    "count_records_by_category": _with(TRENDING, CATS, VALID, _selection("sel", C.FOCUS))
    + f"""SELECT s.category_id, c.title AS category, CAST(coalesce(n.n_records, 0) AS BIGINT) AS n_records
FROM sel s LEFT JOIN cats c ON s.category_id = c.category_id
LEFT JOIN (SELECT category_id, count(*) AS n_records FROM valid WHERE category_id IN ({FOCUS}) GROUP BY category_id) n
  ON s.category_id = n.category_id""",
    "sum_views_by_category": _sum_by_category(("views",)),
    "sum_likes_dislikes_by_category": _sum_by_category(("likes", "dislikes")),
    "sort_records_by_views": _with(TRENDING, CATS, VALID)
    + f"""SELECT t.category_id, c.title AS category, t.video_id, t.trending_date, t.title, t.channel_title,
       t.publish_date, t.views, t.likes, t.dislikes
FROM valid t LEFT JOIN cats c ON t.category_id = c.category_id
WHERE t.category_id IN ({FOCUS}) AND t.views >= 0""",
    "filter_records_by_category": _with(TRENDING, VALID)
    + f"SELECT category_id, {_display_line(False)} AS line FROM valid WHERE category_id = {C.SINGLE_CATEGORY} AND {DISPLAY_READY}",
    "topk_records_by_category_views": _topk_records("views"),
    "topk_records_by_category_likes": _topk_records("likes"),
    **{name: _records_in_range(r) for name, r in C.RANGE_QUERIES.items()},
    "count_in_range": _with(TRENDING, VALID, _selection("sel", C.FOCUS))
    + f"""SELECT s.category_id, CAST(coalesce(sum(n.n), 0) AS BIGINT) AS n_records,
       CAST(grouping(s.category_id) AS INTEGER) AS is_total
FROM sel s LEFT JOIN (SELECT category_id, count(*) AS n FROM valid WHERE {_range_where(C.SUMMARY_RANGE)}
                      GROUP BY category_id) n ON s.category_id = n.category_id
GROUP BY ROLLUP (s.category_id)""",
    "run_summary": _with(TRENDING)
    + f"""SELECT count(*) AS n_read,
       CAST(0 AS BIGINT) AS n_malformed,
       count(*) FILTER (WHERE video_id IS NOT NULL AND category_id IS NOT NULL) AS n_valid,
       count(*) FILTER (WHERE video_id IS NOT NULL AND category_id IN ({FOCUS})) AS n_output,
       count(*) FILTER (WHERE NOT coalesce(video_id IS NOT NULL AND category_id IN ({FOCUS}), false)) AS n_skipped,
       count(DISTINCT CASE WHEN video_id IS NOT NULL AND category_id IN ({FOCUS}) THEN category_id END) AS n_groups
FROM trending""",
    "as_field_map": _with(TRENDING) + _FIELD_MAP,
}
# The CSV round trips must give exactly the results of the direct queries.
ORACLE["rollup_videos_from_csv"] = ORACLE["rollup_videos"]
ORACLE["rollup_videos_from_csv_lines"] = ORACLE["rollup_videos"]
ORACLE["sum_likes_dislikes_from_csv_lines"] = ORACLE["sum_likes_dislikes_by_category"]

_DIRTY_SUMMARY = """SELECT count(*) AS n_read, count(*) FILTER (WHERE malformed) AS n_malformed,
       count(*) FILTER (WHERE ok) AS n_valid, count(*) FILTER (WHERE ok AND focus) AS n_output,
       count(*) FILTER (WHERE NOT (ok AND focus)) AS n_skipped,
       count(DISTINCT CASE WHEN ok AND focus THEN category_id END) AS n_groups
FROM (SELECT *, NOT malformed AND category_id IS NOT NULL AND coalesce(views >= 0 AND likes >= 0 AND dislikes >= 0, false) AS ok,
             coalesce(category_id IN (""" + FOCUS + """), false) AS focus FROM dirty)"""

ORACLE |= {
    "topk_records_by_category_views_many": ORACLE["topk_records_by_category_views"].replace(
        f"rank <= {C.K_PER_CATEGORY}", f"rank <= {C.K_MANY}"
    ),
    "menu_topk_videos_known": _topk("views").replace(
        f"category_id IN ({FOCUS})",
        f"category_id IN ({_ids(C.CHOSEN_WITH_UNKNOWN)}) AND category_id IN (SELECT category_id FROM cats)",
    ),
    "topk_counts_with_total": ORACLE["count_in_range"].replace(
        _range_where(C.SUMMARY_RANGE), f"category_id IN ({FOCUS}) AND {DISPLAY_READY}"
    ),
    "filtered_record_count": _with(TRENDING, VALID)
    + f"SELECT count(*) AS n_records FROM valid WHERE category_id = {C.SINGLE_CATEGORY} AND {DISPLAY_READY}",
    "single_line_titles": _with(TRENDING)
    + "SELECT video_id, title || ' ' || channel_title || ' ' || CAST(views AS VARCHAR) AS line FROM trending",
    "dirty_rejected_by_reason": _with(_dirty(True))
    + """SELECT reason, count(*) AS n_records FROM (
  SELECT CASE WHEN malformed THEN 'malformed' WHEN category_id IS NULL THEN 'category_id' WHEN title IS NULL THEN 'title'
              WHEN views IS NULL OR views < 0 THEN 'views' WHEN likes IS NULL OR likes < 0 THEN 'likes'
              WHEN dislikes IS NULL OR dislikes < 0 THEN 'dislikes' WHEN publish_date IS NULL THEN 'publish_date' END AS reason
  FROM dirty) WHERE reason IS NOT NULL GROUP BY reason""",
    "dirty_run_summary": _with(_dirty(True)) + _DIRTY_SUMMARY,
    "dirty_run_summary_lines": _with(_dirty(False)) + _DIRTY_SUMMARY,
    "dirty_rollup_videos": _with(_dirty(True), CATS, _videos_of("dirty")) + f"SELECT {VIDEO_COLS} FROM videos",
    "dirty_rollup_videos_lines": _with(_dirty(False), CATS, _videos_of("dirty")) + f"SELECT {VIDEO_COLS} FROM videos",
    "dirty_filter_records": _with(_dirty(True))
    + f"""SELECT category_id, {_display_line(False)} AS line FROM dirty
WHERE NOT malformed AND category_id = {C.SINGLE_CATEGORY} AND {DISPLAY_READY}""",
    "dirty_dated_by_category": _with(_dirty(True))
    + f"""SELECT category_id, count(*) AS n_records FROM dirty
WHERE NOT malformed AND category_id IS NOT NULL AND publish_date >= DATE '{C.YEAR}-01-01' GROUP BY category_id""",
}
