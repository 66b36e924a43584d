"""DuckDB SQL for the rows of ``op1_ann``: all distances.  Where the table has few lists, all of them are read."""

ANN_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, CAST(embedding AS DOUBLE[]) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
usual AS (SELECT len(e) AS n FROM v GROUP BY n ORDER BY count(*) DESC, n LIMIT 1),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, min(sqrt(list_reduce(list_transform(range(1, len(q.e) + 1), lambda i: (q.e[i] - c.e[i]) * (q.e[i] - c.e[i])), lambda a, b: a + b))) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
  WHERE len(q.e) = (SELECT n FROM usual)
  GROUP BY ALL)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS rank, vec_id, score
FROM pairs
QUALIFY rank <= 10
"""
