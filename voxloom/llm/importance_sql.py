"""DuckDB SQL for the rows of ``op12_importance_resampling``; the checksum is computed from its rule, half a byte at a time."""


def _half_byte_table() -> list[int]:
    out = []
    for c in range(16):
        for _ in range(4):
            c = c >> 1 ^ (0xEDB88320 if c & 1 else 0)
        out.append(c)
    return out


_TABLE = f"({_half_byte_table()}::BIGINT[])"
_STEP = f"xor(a >> 4, {_TABLE}[1 + (xor(a, b) & 15)])"
# Low half first.
_HALVES = "flatten(list_transform(regexp_extract_all(hex(encode(f)), '..'), lambda x: [('0x' || x[2])::BIGINT, ('0x' || x[1])::BIGINT]))"
_CRC = f"xor(list_reduce(list_concat([4294967295::BIGINT], {_HALVES}), lambda a, b: {_STEP}), 4294967295::BIGINT)"


def _words(text: str) -> str:
    lower = f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"regexp_extract_all({lower}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


def _runs(table: str) -> str:
    return f"""SELECT row, unnest(list_concat(w,
        list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
        list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS f FROM {table}"""


IMPORTANCE_SQL = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS row, doc_id, {_words('text')} AS w FROM documents),
q AS (SELECT row_number() OVER () AS row, {_words('text')} AS w FROM benchmark),
df AS MATERIALIZED (SELECT row, f, count(*) AS n FROM ({_runs('d')}) GROUP BY ALL),
qf AS MATERIALIZED (SELECT f, count(*) AS n FROM ({_runs('q')}) GROUP BY ALL),
names AS MATERIALIZED (SELECT f, {_CRC} % 10000 AS bucket FROM (SELECT f FROM df UNION SELECT f FROM qf)),
s AS (SELECT bucket, sum(n) AS n FROM df JOIN names USING (f) GROUP BY bucket),
t AS (SELECT bucket, sum(n) AS n FROM qf JOIN names USING (f) GROUP BY bucket),
sums AS (SELECT (SELECT coalesce(sum(n), 0) FROM s)::DOUBLE AS s, (SELECT coalesce(sum(n), 0) FROM t)::DOUBLE AS t),
gain AS (SELECT bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * (sums.s + 10000) / ((coalesce(s.n, 0) + 1)::DOUBLE * (sums.t + 10000))))::BIGINT AS g
         FROM s FULL JOIN t USING (bucket) CROSS JOIN sums),
weight AS (SELECT row, sum(n)::BIGINT AS n_features, sum(n * g)::BIGINT AS weight FROM df JOIN names USING (f) JOIN gain USING (bucket) GROUP BY row),
noise AS (SELECT row, doc_id, len(w) AS n_words, ('0x' || sha256('42:' || coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT AS h FROM d),
scores AS (SELECT row, doc_id, n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
             coalesce(weight, 0) + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM noise LEFT JOIN weight USING (row)),
places AS (SELECT row, row_number() OVER (ORDER BY score DESC, doc_id NULLS FIRST, n_features, row) AS place, count(*) OVER () AS n FROM scores WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 5 * n // 100 THEN place END AS rank
FROM scores LEFT JOIN places USING (row)
"""
