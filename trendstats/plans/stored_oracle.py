"""DuckDB SQL of ``plans.stored.QUERIES``."""

from __future__ import annotations

from trendstats.plans import catalog as C
from trendstats.plans import oracle as O
from trendstats.plans import stored as S
from trendstats.schema import VIDEO_CSV_HEADER

_CSV = (
    "title || ',' || category_id || ':' || coalesce(category, 'null') || ',' || CAST(publish_date AS VARCHAR) || ',' ||"
    " CAST(trending_date AS VARCHAR) || ',' || channel_title || ',' || views || ',' || likes || ',' || dislikes || ',' || url"
)
_HEADER = f"'{','.join(VIDEO_CSV_HEADER)}'"


def _is(rule: tuple[int, int]) -> str:
    return f"n_nationkey % {rule[0]} = {rule[1]}"


_ITEMS = f"""items AS (
  SELECT CASE WHEN NOT ({_is(S.BAD_ID)}) THEN CAST(n_nationkey AS INTEGER) END AS category_id,
         CASE WHEN NOT ({_is(S.BAD_TITLE)}) THEN n_name END AS title, n_nationkey % 2 = 0 AS assignable FROM nation)"""
_TOP_LIKES = O.ORACLE["topk_videos_by_category_likes"]
_PAGE_ORDER = ", ".join(["views DESC"] + [f"{c} ASC NULLS FIRST" for c in O.RECORD_TIEBREAK if c != "views"])

ORACLE: dict[str, str] = {
    "rollup_videos_incremental": O.ORACLE["rollup_videos"],
    "rollup_videos_bucketed": O.ORACLE["rollup_videos"],
    "sum_views_by_category_wide": O.ORACLE["sum_views_by_category"].replace(
        "CAST(sum(t.views) AS BIGINT) AS views", f"CAST(sum(CAST(t.views AS HUGEINT) * {S.SCALE}) AS VARCHAR) AS views"
    ),
    "records_last_month_dated": O.ORACLE["records_last_month"],
    "records_page": O._with(O.TRENDING, O.VALID)
    + f"""SELECT * FROM (
  SELECT category_id, {', '.join(O.RECORD_TIEBREAK)}, CAST(row_number() OVER (ORDER BY {_PAGE_ORDER}) AS BIGINT) AS rank
  FROM valid WHERE category_id = {C.SINGLE_CATEGORY}) WHERE rank BETWEEN {S.PAGE[0]} AND {S.PAGE[1]}""",
    "dirty_routed": O.ORACLE["dirty_rejected_by_reason"]
    .replace("SELECT reason, count(*)", "SELECT CASE WHEN reason IS NULL THEN 'accepted' ELSE 'rejected' END AS route, reason, count(*)")
    .replace("WHERE reason IS NOT NULL GROUP BY reason", "GROUP BY reason"),
    "category_document_items": O._with(_ITEMS)
    + """SELECT *, CASE WHEN category_id IS NULL THEN 'id' WHEN title IS NULL THEN 'title' END AS reason FROM items""",
    "category_labels": O._with(O.CATS) + "SELECT category_id || ':' || title AS label, category_id FROM cats",
    "video_csv_by_category": O._with(O.TRENDING, O.CATS, O.VIDEOS)
    + f"SELECT category_id, {_CSV} AS line FROM videos WHERE category_id IN ({O.FOCUS})",
    "ranked_csv_file": f"""SELECT CAST(rank AS INTEGER) AS line_no, {_CSV} AS line FROM ({O.ORACLE["topk_videos_views"]})
UNION ALL SELECT 0, {_HEADER}""",
    "named_category_files": f"""WITH top AS ({_TOP_LIKES})
SELECT category || '.csv' AS file, CAST(rank AS INTEGER) AS line_no, {_CSV} AS line FROM top
UNION ALL SELECT DISTINCT category || '.csv', 0, {_HEADER} FROM top""",
    "ranked_text_by_category": f"SELECT category_id, rank || ': ' || line AS line FROM ({O.ORACLE['topk_records_by_category_likes']})",
    "dated_text_by_category": f"SELECT category_id, rank || ': ' || line AS line FROM ({O.ORACLE['records_last_6_months']})",
    "tuple_text": f"""SELECT '(' || category || ',' || likes || ',' || dislikes || ')' AS line
FROM ({O.ORACLE['sum_likes_dislikes_by_category']})""",
    "display_text": f"SELECT line FROM ({O.ORACLE['filter_records_by_category']})",
    "views_sort_text": O._with(O.TRENDING, O.VALID, _ITEMS)
    + f"""SELECT coalesce(i.title, CAST(v.category_id AS VARCHAR)) || ': ' || video_id || ',' || CAST(trending_date AS VARCHAR) || ',' ||
       v.title || ',' || channel_title || ',' || v.category_id || ',' || CAST(publish_date AS VARCHAR) || 'T00:00:00.000Z,none,' ||
       views || ',' || likes || ',' || dislikes || ',0,thumb/' || video_id || ',False,False,False,snapshot of ' || video_id AS line
FROM valid v LEFT JOIN items i ON i.category_id = v.category_id WHERE v.category_id IN ({O.FOCUS}) AND views >= 0""",
}
