"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

OP4 = r"""
WITH doc AS (
  SELECT doc_id, row_number() OVER () AS r,
         list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
  FROM documents),
item AS (
  SELECT item_id,
         list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
  FROM benchmark),
size AS (
  SELECT *, least(10, len(words)) AS n FROM item WHERE len(words) > 0),
win AS (
  SELECT DISTINCT item_id, n, list_slice(words, s, s + n - 1) AS w
  FROM (SELECT item_id, n, words, unnest(generate_series(1, len(words) - n + 1)) AS s FROM size)),
lengths AS (SELECT DISTINCT n FROM win),
place AS (
  SELECT r, n, s, list_slice(words, s, s + n - 1) AS w
  FROM (SELECT r, words, n, unnest(generate_series(1, len(words) - n + 1)) AS s
        FROM doc, lengths WHERE len(words) >= n)),
hit AS (SELECT r, place.n, s, item_id FROM place JOIN win ON place.n = win.n AND place.w = win.w),
word AS (SELECT r, count(DISTINCT p) AS n_hit
         FROM (SELECT r, unnest(generate_series(s, s + n - 1)) AS p FROM hit) GROUP BY r),
ids AS (SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
        FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS i FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN word USING (r) LEFT JOIN ids USING (r)
"""

OP9 = r"""
WITH doc AS (
  SELECT doc_id, row_number() OVER () AS r,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM documents),
place AS (
  SELECT r, doc_id, s, array_to_string(list_slice(words, s, s + 12), ' ') AS w
  FROM (SELECT r, doc_id, words, unnest(generate_series(1, len(words) - 12)) AS s FROM doc WHERE len(words) >= 13)),
least_id AS (SELECT w, min(doc_id) AS d FROM place GROUP BY w HAVING count(*) > 1),
gone AS (
  SELECT DISTINCT r, unnest(generate_series(s, s + 12)) AS p
  FROM place JOIN least_id USING (w) WHERE d < doc_id OR doc_id IS NULL AND d IS NOT NULL),
lost AS (SELECT r, list(p) AS ps FROM gone GROUP BY r)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string(
         CASE WHEN ps IS NULL THEN words
              ELSE list_filter(words, lambda w, i: NOT list_contains(ps, i)) END, ' '), '')) AS kept_sha256
FROM doc LEFT JOIN lost USING (r)
"""

OP10 = r"""
WITH doc AS (
  SELECT doc_id, text, row_number() OVER () AS r, string_split(text, chr(10)) AS lines FROM documents),
place AS (
  SELECT r, doc_id, s, list_slice(lines, s, s + 2) AS w
  FROM (SELECT r, doc_id, lines, unnest(generate_series(1, len(lines) - 2)) AS s FROM doc WHERE len(lines) >= 3)),
ranked AS (
  SELECT r, s, doc_id, min(doc_id) OVER (PARTITION BY w) AS d, min(s) OVER (PARTITION BY w, r) AS own FROM place),
gone AS (
  SELECT DISTINCT r, unnest(generate_series(s, s + 2)) AS p
  FROM ranked WHERE d < doc_id OR doc_id IS NULL AND d IS NOT NULL OR own < s),
lost AS (SELECT r, list(p) AS ps FROM gone GROUP BY r)
SELECT doc_id, CAST(coalesce(len(lines), 0) AS BIGINT) AS n_lines, CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed,
       CASE WHEN ps IS NULL THEN text
            ELSE coalesce(array_to_string(list_filter(lines, lambda x, i: NOT list_contains(ps, i)), chr(10)), '')
            END AS text
FROM doc LEFT JOIN lost USING (r)
"""

ORACLES: dict[str, str] = {
    "op4_benchmark_decontamination": OP4,
    "op9_substring_dedup": OP9,
    "op10_line_dedup": OP10,
}
