"""SQL (DuckDB) for the queries that it can express, written from the contracts."""

from __future__ import annotations

QUALITY_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d
), windows AS (
  SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS win
  FROM (SELECT r, ws, unnest(generate_series(1, len(ws) - 2)) AS i FROM w WHERE len(ws) >= 3)
), repeated AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS c FROM windows) WHERE c > 1
), covered AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM repeated) GROUP BY r
), lines AS (
  SELECT r, host, line, lower(trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g'))) AS k,
         len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n
  FROM (SELECT r, host, unnest(string_split(t, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), dup AS (
  SELECT r, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY r
), different AS (
  SELECT DISTINCT r, host, k FROM lines
), texts AS (
  SELECT r, list_sort(list(k)) AS ks FROM different GROUP BY r
), frequent AS (
  SELECT host, k FROM different JOIN texts USING (r) GROUP BY host, k HAVING count(DISTINCT ks) > 10
), touched AS (
  SELECT x.r, x.host, x.k, f.k IS NOT NULL AS often, string_split(x.k, ' ') AS ws
  FROM different x LEFT JOIN frequent f ON f.host = x.host AND f.k = x.k
  WHERE x.r IN (SELECT r FROM different JOIN frequent USING (host, k))
), sketched AS (
  SELECT r, host, k, often, list_slice(list_sort(list_distinct(list_transform(range(1, greatest(len(ws) - 2, 1) + 1),
         lambda i: array_to_string(list_slice(ws, i, i + 2), ' ')))), 1, 8) AS sketch FROM touched
), frequent_windows AS (
  SELECT DISTINCT host, unnest(sketch) AS win FROM sketched WHERE often
), changed AS (
  SELECT r, k FROM (SELECT r, host, k, len(sketch) AS size, unnest(sketch) AS win FROM sketched WHERE NOT often)
  JOIN frequent_windows USING (host, win) GROUP BY r, k, size HAVING count(*) >= 0.25 * size
), own AS (
  SELECT r, list_sort(list(k)) AS ks FROM touched x WHERE NOT often AND NOT EXISTS (SELECT 1 FROM changed c WHERE c.r = x.r AND c.k = x.k) GROUP BY r
), told AS (
  SELECT r, own.ks IS NULL AS copy, coalesce(own.ks, [least]) AS of
  FROM (SELECT r, min(k) AS least FROM touched WHERE often GROUP BY r) LEFT JOIN own USING (r)
), common AS (
  SELECT host, k FROM touched JOIN told USING (r) WHERE often GROUP BY host, k HAVING count(DISTINCT (copy, of)) > 10
), removed AS (
  SELECT r, sum(n) AS n FROM lines JOIN common USING (host, k) GROUP BY r
), stats AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
         (len(ws) - coalesce(removed.n, 0))::BIGINT AS left_words
  FROM d JOIN w USING (r) LEFT JOIN dup USING (r) LEFT JOIN covered USING (r) LEFT JOIN removed USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND left_words >= 0.3 * n_words AS kept, left_words
FROM stats
"""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all(" + _LOWER.format("coalesce(text, '')") + r", '(?:[0-9a-z]|[^\x00-\x7F])+')"

CONTAMINATION_SQL = f"""
WITH b AS (
  SELECT item_id, {_WORDS} AS ws FROM benchmark
), win AS (
  SELECT DISTINCT item_id::VARCHAR AS item, list_slice(ws, i, i + 9) AS span
  FROM (SELECT item_id, ws, unnest(generate_series(1, greatest(len(ws) - 9, 1))) AS i FROM b WHERE len(ws) > 0)
), lens AS (
  SELECT DISTINCT len(span) AS n FROM win
), d AS (
  SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS ws FROM documents
), spans AS (
  SELECT r, n, i, list_slice(ws, i, i + n - 1) AS span
  FROM (SELECT r, ws, n, unnest(generate_series(1, len(ws) - n + 1)) AS i FROM d CROSS JOIN lens WHERE len(ws) >= n)
), found AS (
  SELECT r, i, n, item FROM spans JOIN win USING (span)
), hit AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(generate_series(i, i + n - 1)) AS p FROM (SELECT DISTINCT r, i, n FROM found)) GROUP BY r
), items AS (
  SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, item FROM found) GROUP BY r
), term AS (
  SELECT span, unnest(span) AS w, unnest(generate_series(1, len(span))) AS o FROM (SELECT DISTINCT span FROM win)
), place AS (
  SELECT r, w, p FROM (SELECT r, unnest(ws) AS w, unnest(generate_series(1, len(ws))) AS p FROM d) WHERE w IN (SELECT w FROM term)
), often AS (
  SELECT w, count(*) AS c FROM place GROUP BY w
), rarest AS (
  SELECT span, arg_min(w, (c, o)) AS w, count(DISTINCT w) AS n FROM term LEFT JOIN often USING (w)
  GROUP BY span HAVING count(c) = count(*)
), near AS (
  SELECT a.r, t.span, a.p FROM rarest x JOIN place a USING (w) JOIN (SELECT DISTINCT span, w FROM term) t ON t.span = x.span
  JOIN place b ON b.r = a.r AND b.w = t.w AND abs(a.p - b.p) <= 20
  GROUP BY a.r, t.span, a.p, x.n HAVING count(DISTINCT t.w) = x.n
), near_items AS (
  SELECT r, count(DISTINCT item) AS n FROM near JOIN win USING (span) GROUP BY r
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit, coalesce(items.n, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, hit.n IS NOT NULL AS contaminated,
       coalesce(near_items.n, 0)::BIGINT AS n_near
FROM d LEFT JOIN hit USING (r) LEFT JOIN items USING (r) LEFT JOIN near_items USING (r)
"""
