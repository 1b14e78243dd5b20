"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _low(text: str) -> str:
    return f"translate({text}, '{_UPPER}', '{_LOWER}')"


_TOKENS = r"'[^\x20\x09-\x0D]+'"
_WORDS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

LM_SCORES = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id,
                  coalesce(regexp_extract_all({_low("text")}, {_TOKENS}), []) AS ws FROM documents),
p AS (SELECT rid, ws, unnest(range(1, len(ws) + 1)) AS i FROM d),
t AS (SELECT rid, ws[i] AS w, CASE WHEN i > 1 THEN ws[i - 1] ELSE '' END AS v FROM p),
uni AS (SELECT w, count(*) AS c FROM t GROUP BY w UNION ALL SELECT '', count(DISTINCT rid) FROM t),
bi AS (SELECT v, w, count(*) AS c FROM t GROUP BY v, w),
n AS (SELECT count(*) AS n FROM t),
s AS (SELECT t.rid, count(*) FILTER (WHERE bi.c > 1) AS n_seen,
             sum(CASE WHEN bi.c > 1 THEN ln(bi.c - 1) - ln(u.c - 1) ELSE ln(0.4) + ln(x.c) - ln(n.n) END) AS score
      FROM t JOIN bi ON bi.v = t.v AND bi.w = t.w JOIN uni u ON u.w = t.v JOIN uni x ON x.w = t.w, n GROUP BY t.rid)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, coalesce(s.n_seen, 0) AS n_seen,
       round(coalesce(s.score, 0), 3) AS score,
       CASE WHEN len(d.ws) > 0 THEN round(s.score / len(d.ws), 3) END AS score_per_word
FROM d LEFT JOIN s ON d.rid = s.rid"""

DECONTAMINATION = f"""
WITH items AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
                      regexp_extract_all({_low("text")}, {_WORDS}) AS ws FROM benchmark WHERE text IS NOT NULL),
starts AS (SELECT item, ws, least(len(ws), 10) AS n, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS i
           FROM items WHERE len(ws) > 0),
windows AS (SELECT DISTINCT item, n, array_to_string(ws[i:i + n - 1], ' ') AS g FROM starts),
d AS (SELECT row_number() OVER () AS rid, doc_id,
             coalesce(regexp_extract_all({_low("text")}, {_WORDS}), []) AS ws FROM documents),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (SELECT rid, n, ws, unnest(range(1, len(ws) - n + 2)) AS i FROM d, sizes),
grams AS (SELECT rid, n, i, array_to_string(ws[i:i + n - 1], ' ') AS g FROM places),
hits AS (SELECT grams.rid, grams.i, grams.n, windows.item FROM grams JOIN windows ON grams.n = windows.n AND grams.g = windows.g),
hit_words AS (SELECT rid, count(DISTINCT j) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS j FROM hits) GROUP BY rid),
names AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
          FROM (SELECT DISTINCT rid, item FROM hits) GROUP BY rid)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(m.n_items, 0) AS n_items,
       sha256(coalesce(m.names, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words h ON d.rid = h.rid LEFT JOIN names m ON d.rid = m.rid"""

MIX = f"""
WITH w AS (SELECT doc_id, avg(quality) + 0.5 AS weight FROM labels
           WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
d AS (SELECT documents.doc_id, source, CAST(coalesce(len(regexp_extract_all(text, {_TOKENS})), 0) AS BIGINT) AS size,
             -ln((CAST('0x' || substr(md5(coalesce(CAST(documents.doc_id AS VARCHAR), '') || ':mix'), 1, 12) AS BIGINT) + 0.5)
                 / 281474976710656.0) / greatest(coalesce(w.weight, 1.0), 1e-6) AS key
      FROM documents LEFT JOIN w ON documents.doc_id = w.doc_id),
s AS (SELECT source, sum(size) AS source_size, 2.0 * sum(size) AS cap,
             [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1] AS w
      FROM d GROUP BY source),
held AS (SELECT *, sum(cap) OVER up AS capped, sum(w) OVER (ORDER BY cap / w, source DESC NULLS FIRST
                ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS free,
                lead(cap / w) OVER (ORDER BY cap / w, source DESC NULLS FIRST) AS next_ratio, 1.5 * sum(source_size) OVER () AS budget
         FROM s WINDOW up AS (ORDER BY cap / w, source DESC NULLS FIRST ROWS UNBOUNDED PRECEDING)),
rates AS (SELECT (budget - capped) / free AS rate, next_ratio FROM held WHERE free > 0
          UNION ALL SELECT max(budget) / sum(w), min(cap / w) FROM held),
rate AS (SELECT max(rate) AS rate FROM rates WHERE next_ratio > rate),
plan AS (SELECT source, CAST(source_size AS BIGINT) AS source_size, least(cap, w * rate) AS target FROM s, rate),
steps AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM plan),
x AS (SELECT d.doc_id, d.source, d.size, p.source_size, p.target, p.epochs,
             CAST(floor(p.target) AS BIGINT) - p.epochs * p.source_size AS rest,
             CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id ASC NULLS LAST, d.size
                                    ROWS UNBOUNDED PRECEDING) AS BIGINT) AS sum_to
      FROM d JOIN steps p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, round(target, 6) AS target,
       CAST(epochs * size + greatest(0, least(size, rest - sum_to + size)) AS BIGINT) AS taken, source
FROM x"""


def url_filter(rules: list[tuple[str, str, str]]) -> str:
    """SQL of the url query for ``(host, path, verdict)`` rules."""
    site = "regexp_extract(substr({0}, strpos({0}, '://') + 3), '^[^/?#]*')"
    host = f"CASE WHEN contains({{0}}, '://') THEN {_low(site)} ELSE '' END"
    path = "CASE WHEN contains({0}, '://') THEN regexp_extract(substr({0}, strpos({0}, '://') + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END"
    dotless = (
        f"CASE WHEN contains({path}, '/.') THEN list_reduce(string_split({path}, '/'), lambda a, x: CASE WHEN x = '.' THEN a"
        f" WHEN x = '..' THEN regexp_replace(a, '/[^/]*$', '') ELSE a || '/' || x END)"
        f" || CASE WHEN regexp_matches({path}, '/\\.\\.?$') THEN '/' ELSE '' END ELSE {path} END"
    )
    node = f"nullif({host}, '') || {dotless} || regexp_extract({{0}}, '^[^?#]*(\\?[^#]*)', 1)"
    values = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in rules)
    href = r"""'(?is)\bhref\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))'"""
    return rf"""
WITH RECURSIVE rules(rh, rp, rv) AS (VALUES {values}),
pages_ AS (SELECT row_number() OVER () AS rid, page_id, url, html, {host.format("url")} AS h0, {path.format("url")} AS p0,
                  {node.format("url")} AS node FROM pages),
own AS (SELECT rid, page_id, node, coalesce(h0, '') AS host, coalesce(p0, '') AS path FROM pages_),
links AS (SELECT url, node, unnest(regexp_extract_all(html, '(?is)<link\b[^>]*>')) AS tag FROM pages_ WHERE node IS NOT NULL),
metas AS (SELECT url, node, unnest(regexp_extract_all(html, '(?is)<meta\b[^>]*>')) AS tag FROM pages_ WHERE node IS NOT NULL),
raw AS (SELECT url, node, regexp_extract(tag, {href}, 1) || regexp_extract(tag, {href}, 2) || regexp_extract(tag, {href}, 3) AS t
        FROM links WHERE regexp_matches(tag, '(?is)\brel\s*=\s*["'']?\s*canonical\b')
        UNION ALL
        SELECT url, node, regexp_extract(tag, '(?is)\burl\s*=\s*["'']?([^"''>\s]+)', 1)
        FROM metas WHERE regexp_matches(tag, '(?is)\bhttp-equiv\s*=\s*["'']?\s*refresh\b')),
named AS (SELECT url, node, replace(trim(t), '&amp;', '&') AS t FROM raw),
found AS (SELECT node AS a, CASE
            WHEN regexp_matches(t, '^(?i)https?://') THEN t
            WHEN starts_with(t, '//') THEN substr(url, 1, strpos(url, '://') - 1) || ':' || t
            WHEN starts_with(t, '/') THEN regexp_extract(url, '^(.*?://[^/?#]*)', 1) || t
            WHEN starts_with(t, '?') THEN regexp_extract(url, '^(.*?://[^?#]*)', 1) || t
            WHEN t <> '' AND NOT regexp_matches(t, '^(?:[A-Za-z][A-Za-z0-9+.-]*:|#)')
              THEN regexp_replace(regexp_extract(url, '^(.*?://[^/?#]*(?:/[^?#]*/|/)?)', 1), '/?$', '/') || t END AS target
          FROM named),
edges AS (SELECT a, {node.format("target")} AS b FROM found),
both_ AS (SELECT a, b FROM edges WHERE b IS NOT NULL UNION SELECT b, a FROM edges WHERE b IS NOT NULL),
reach(node, root) AS (SELECT DISTINCT a, a FROM both_ UNION SELECT both_.b, reach.root FROM reach JOIN both_ ON both_.a = reach.node),
members AS (SELECT node, min(root) AS component FROM reach GROUP BY node),
places AS (SELECT DISTINCT host, path FROM own
           UNION SELECT DISTINCT {host.format("'x://' || node")}, {path.format("'x://' || node")} FROM members),
best AS (SELECT host, path, arg_max(rh || rp, length(rh || rp) * 2 + CAST(rv = 'allow' AS INTEGER)) AS rule,
                arg_max(rv, length(rh || rp) * 2 + CAST(rv = 'allow' AS INTEGER)) AS rv
         FROM places JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY host, path),
spread AS (SELECT m.component, bool_or(b.rv = 'allow') AS any_allow, bool_or(b.rv = 'block') AS any_block
           FROM members m JOIN best b ON b.host = {host.format("'x://' || m.node")} AND b.path = {path.format("'x://' || m.node")}
           GROUP BY m.component)
SELECT own.page_id, own.host, own.path, best.rule,
       coalesce(best.rv, CASE WHEN spread.any_block AND NOT spread.any_allow THEN 'block' ELSE 'allow' END) AS verdict
FROM own LEFT JOIN best ON own.host = best.host AND own.path = best.path
LEFT JOIN members ON own.node = members.node LEFT JOIN spread ON members.component = spread.component"""


HARD_NEGATIVES = """
WITH r AS (
  SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.rid, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM r a JOIN r b ON b.vec_id IS DISTINCT FROM a.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT rid, anchor_id, vec_id, score, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id NULLS LAST) AS place
  FROM s WHERE same QUALIFY place <= 5),
n AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.rid, p.place ORDER BY s.score DESC, s.vec_id NULLS LAST) AS rank
  FROM p JOIN s ON s.rid = p.rid AND NOT s.same AND 80 * p.score <= 100 * s.score AND s.score <= p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5"""
