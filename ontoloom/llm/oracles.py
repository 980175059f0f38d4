"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

_WS = r"[\x20\x09-\x0D]+"

OP4 = rf"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '{_WS}', ' ', 'g')) AS h FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY h) AS keep_id,
       CAST(count(*) OVER (PARTITION BY h) AS BIGINT) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY h) AS kept, h AS text_sha256
FROM d
"""

OP9 = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WS}'), lambda x: x <> '') AS a
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(a) = 0 THEN [] WHEN len(a) < 3 THEN [array_to_string(a, ' ')]
    ELSE list_transform(range(1, CAST(len(a) AS BIGINT) - 1), lambda i: a[i] || ' ' || a[i + 1] || ' ' || a[i + 2]) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS u, y.doc_id AS v, count(*) AS i FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
e AS (SELECT u, v FROM p JOIN n a ON a.doc_id = u JOIN n b ON b.doc_id = v WHERE 100 * i >= 85 * (a.n + b.n - i)),
r(u, v) AS (SELECT doc_id, doc_id FROM w UNION SELECT r.u, e.v FROM r JOIN e ON e.u = r.v),
c AS (SELECT u, min(v) AS component_id FROM r GROUP BY u)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id, w.doc_id = component_id AS kept
FROM w JOIN c ON c.u = w.doc_id LEFT JOIN n ON n.doc_id = w.doc_id
"""

OP2 = r"""
WITH rules(verdict, h, p) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
u AS (
  SELECT page_id, CASE WHEN instr(coalesce(url, ''), '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
s AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
m AS (
  SELECT page_id, max(struct_pack(n := length(h || p), hl := length(h), rule := h || p, verdict := verdict)) AS best
  FROM s JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id)
SELECT s.page_id, host, path, best.rule AS rule, coalesce(best.verdict, 'allow') AS verdict FROM s LEFT JOIN m ON m.page_id = s.page_id
"""

OP6 = r"""
WITH p AS (
  SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS a, CASE WHEN page_id % 97 = 13 THEN substr(coalesce(html, ''), 1, 100) || '#' || substr(coalesce(html, ''), 102) ELSE coalesce(html, '') END AS b FROM pages),
r AS (
  SELECT page_id, page_id // 256 AS file, strlen(a) AS la, strlen(b) AS lb,
    'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:' || page_id || '>' || chr(13) || chr(10) || 'WARC-Target-URI: ' || url || chr(13) || chr(10) || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: ' AS head,
    chr(13) || chr(10) || chr(13) || chr(10) AS gap, a, b FROM p),
t AS (SELECT page_id, file, head || la || gap || a || gap AS ra, head || lb || gap || b || gap AS rb FROM r),
o AS (
  SELECT *, sum(strlen(ra)) OVER (PARTITION BY file ORDER BY page_id) - strlen(ra) AS oa, sum(strlen(rb)) OVER (PARTITION BY file ORDER BY page_id) - strlen(rb) AS ob FROM t),
x AS (SELECT file, oa AS o, strlen(ra) AS l, sha256(ra) AS h FROM o),
y AS (SELECT file, ob AS o, strlen(rb) AS l, sha256(rb) AS h FROM o WHERE page_id % 1009 <> 5)
SELECT CAST(coalesce(x.file, y.file) AS BIGINT) AS file, CAST(coalesce(x.o, y.o) AS BIGINT) AS start,
       CASE WHEN y.h IS NULL THEN 'missing' WHEN x.h IS NULL THEN 'extra' ELSE 'changed' END AS problem,
       CAST(x.l AS BIGINT) AS length_a, CAST(y.l AS BIGINT) AS length_b, x.h AS hash_a, y.h AS hash_b
FROM x FULL JOIN y ON x.file = y.file AND x.o = y.o WHERE x.h IS DISTINCT FROM y.h
"""

OP8 = r"""
WITH t AS (
  SELECT conv_id, row_number() OVER w AS pos, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn, coalesce(role, ''), coalesce(text, ''))),
p AS (
  SELECT conv_id, pos, count(*) OVER (PARTITION BY conv_id) AS n,
         string_agg(role || chr(31) || text, chr(30)) OVER (PARTITION BY conv_id ORDER BY pos) AS prefix,
         string_agg('<|' || role || '|>' || chr(10) || text || chr(10), '') OVER (PARTITION BY conv_id ORDER BY pos) AS rendered FROM t),
e AS (SELECT n, prefix, min(conv_id) AS conv_id, count(*) AS copies, any_value(rendered) AS text FROM p WHERE pos = n GROUP BY n, prefix)
SELECT conv_id, CAST(n AS BIGINT) AS n_turns, CAST(copies AS BIGINT) AS copies, text
FROM e WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.pos < p.n AND p.pos = e.n AND p.prefix = e.prefix)
"""

ALL: dict[str, str] = {
    "op2_url_filter": OP2,
    "op4_exact_dedup": OP4,
    "op6_warc_audit": OP6,
    "op8_chat_format": OP8,
    "op9_minhash_near_dedup": OP9,
}
