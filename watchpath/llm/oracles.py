"""DuckDB SQL for the corpus queries that SQL can express."""

_SPACE = r"[ \t\n\v\f\r]"

OP1 = rf"""
WITH d AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '{_SPACE}', '', 'g') AS content, length(coalesce(text, '')) AS points
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY content) AS group_size,
       row_number() OVER w = 1 AS kept, sha256(content) AS text_sha256
FROM d
WINDOW w AS (PARTITION BY content ORDER BY points DESC, doc_id)
"""

OP5 = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, [x FOR x IN string_split_regex(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_SPACE}+') IF x <> ''] AS w
  FROM documents),
grams AS (
  SELECT DISTINCT doc_id, array_to_string(w[i: i + 4], ' ') AS gram
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
  FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * k >= 80 * (x.n + y.n - k)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT r.a, e.b FROM reached r JOIN ways e ON r.b = e.a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM documents d LEFT JOIN sizes s USING (doc_id)
JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a) c USING (doc_id)
"""

# Pages with an alias link would need their component; the given tables have none, and this says so if one comes.
OP6 = r"""
WITH rules(verdict, h, p) AS (VALUES
  ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
  ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
rest AS (
  SELECT page_id, html, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (
  SELECT page_id, html, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest)
SELECT page_id, any_value(host) AS host, any_value(path) AS path, arg_max(h || p, length(h || p)) AS rule,
       CASE WHEN bool_or(regexp_matches(html, '(?i)rel\s*=\s*["'']?\s*canonical|http-equiv\s*=\s*["'']?\s*refresh'))
            THEN error('pages with alias links') ELSE coalesce(arg_max(verdict, length(h || p)), 'allow') END AS verdict
FROM parts LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
GROUP BY page_id
"""

OP8 = r"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS hex, payload FROM p),
g AS (SELECT *, max(page_id) OVER (PARTITION BY payload) AS stored FROM d)
SELECT page_id, payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         ((('0x' || substr(hex, 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31) + 1, 1) FOR i IN range(32)], '')
         AS payload_digest,
       CASE WHEN page_id = stored THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> stored THEN stored END AS refers_to
FROM g
"""

ORACLES = {"op1_grace_dedup": OP1, "op5_ngram_join": OP5, "op6_url_filter": OP6, "op8_warc": OP8}
