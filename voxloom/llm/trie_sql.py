"""DuckDB SQL for the rows of ``op13_prefix_trie``: every prefix of every rebuilt conversation, grouped."""

from voxloom.llm.importance_sql import _CRC

TRIE_SQL = f"""
WITH t AS MATERIALIZED (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place, sha256(strlen(role) || ':' || role || text) AS k,
    len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
c AS (SELECT conv_id, conv_id - conv_id % 20 AS donor, {_CRC} % 4 AS h FROM (SELECT DISTINCT conv_id, conv_id::VARCHAR AS f FROM t)),
r AS (SELECT c.conv_id, 0 AS part, place, k, words FROM c JOIN t ON t.conv_id = c.donor AND place <= h
      UNION ALL SELECT conv_id, 1, place, k, words FROM c JOIN t USING (conv_id) WHERE place > h),
s AS MATERIALIZED (SELECT conv_id, coalesce(list(k ORDER BY part, place) FILTER (k IS NOT NULL), []) AS ks,
        coalesce(list(words ORDER BY part, place) FILTER (k IS NOT NULL), []) AS ws FROM c LEFT JOIN r USING (conv_id) GROUP BY conv_id),
p AS (SELECT conv_id, ks[1:d] AS pre, d, d = len(ks) AS ends, CASE WHEN d > 0 THEN ws[d] ELSE 0 END AS words
      FROM (SELECT *, unnest(range(0, len(ks) + 1)) AS d FROM s)),
n AS MATERIALIZED (SELECT pre, d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
        coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '') AS ids FROM p GROUP BY pre, d),
kids AS (SELECT pre[1:d - 1] AS pre, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL),
k AS MATERIALIZED (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN kids USING (pre)),
sums AS (SELECT pre[1:up] AS pre, sum((n_children = 0)::BIGINT)::BIGINT AS n_leaves, sum((n_convs - 1) * words)::BIGINT AS saved_tokens
         FROM (SELECT *, unnest(range(0, d + 1)) AS up FROM k) GROUP BY ALL)
SELECT k.conv_id, k.d AS depth, u.conv_id AS parent_conv_id, k.n_convs, k.n_children, n_leaves, saved_tokens, sha256(k.ids) AS ends_sha256
FROM k JOIN sums USING (pre) LEFT JOIN n u ON k.d > 0 AND u.pre = k.pre[1:k.d - 1]
"""
