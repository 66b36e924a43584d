"""The quality rules in DuckDB SQL, written from the definitions."""

from voxloom.llm import rules

_LIST = "[" + ", ".join(f"'{w}'" for w in rules.STOPWORDS) + "]"
_K = len(rules.RULES)


def _post(v: str, p: str) -> str:
    def side(rates: str) -> str:
        return " * ".join(f"{p}.{rates}[{3 * j} + {v}[{j + 1}] + 2]" for j in range(_K))

    good, bad = f"{p}.good * {side('g')}", f"(1 - {p}.good) * {side('b')}"
    return f"(({good}) / (({good}) + ({bad})))"


def _rates(weight: str) -> str:
    return ", ".join(f"(sum(CASE WHEN v[{j + 1}] = {x} THEN {weight} ELSE 0 END) + {rules.SMOOTHING}) / (sum({weight}) + {3 * rules.SMOOTHING})"
                     for j in range(_K) for x in (-1, 0, 1))


def rules_cte(table: str = "documents", prefix: str = "r") -> str:
    """Common table expressions that end in ``{prefix}_out``: all columns of ``table``, the counts and the verdict.

    To be put after ``WITH RECURSIVE``.
    """
    x = prefix
    em, last = [], f"{x}_p0"
    for i in range(1, rules.ITERATIONS + 1):
        em.append(f"{x}_p{i} AS MATERIALIZED (SELECT {{'g': [{_rates('g')}], 'b': [{_rates('b')}], 'good': (sum(g) + 1) / (sum(g) + sum(b) + 2)}} AS p "
                  f"FROM (SELECT v, n * q AS g, n * (1 - q) AS b FROM (SELECT v, n, {_post('v', 'p')} AS q FROM {x}_pat, {last})))")
        last = f"{x}_p{i}"
    g, b = (", ".join([f"{y}::DOUBLE" for y in c] * _K) for c in rules.START_VOTES)
    start = f"{{'g': [{g}], 'b': [{b}], 'good': {rules.START_GOOD}::DOUBLE}}"
    return f"""
{x}_d AS MATERIALIZED (SELECT *, row_number() OVER () AS _rn, coalesce(text, '') AS _t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS _w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS _l FROM {table}),
{x}_win AS (SELECT _rn, i, [_w[i], _w[i + 1], _w[i + 2]] AS g FROM (SELECT _rn, _w, unnest(range(1, len(_w) - 1)) AS i FROM {x}_d)),
{x}_hit AS (SELECT _rn, i FROM (SELECT _rn, i, count(*) OVER (PARTITION BY _rn, g) AS c FROM {x}_win) WHERE c > 1),
{x}_rep AS (SELECT _rn, count(*) AS n_rep FROM (SELECT DISTINCT _rn, unnest([i, i + 1, i + 2]) AS i FROM {x}_hit) GROUP BY _rn),
{x}_m AS MATERIALIZED (SELECT d.* EXCLUDE (_t, _w, _l), len(_w) AS n_words, len(array_to_string(_w, '')) AS word_chars,
    len(_t) - len(regexp_replace(_t, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(_l) - len(list_distinct(_l)) AS n_dup_lines,
    coalesce(n_rep, 0) AS n_repeat_words, len(_l) AS n_lines,
    len(list_filter(_w, lambda w: w = upper(w) AND w <> lower(w))) AS n_upper,
    len(list_filter(_w, lambda w: list_contains({_LIST}, w))) AS n_stop,
    len(list_filter(_l, lambda l: right(rtrim(l, ' '), 1) IN ('.', '!', '?', ':'))) AS n_ends
    FROM {x}_d d LEFT JOIN {x}_rep USING (_rn)),
{x}_v AS MATERIALIZED (SELECT *, CASE WHEN n_words = 0 THEN [{', '.join(['0'] * _K)}] ELSE [
    CASE WHEN 10 * n_symbols > 2 * n_words THEN -1 WHEN 50 * n_symbols <= n_words THEN 1 ELSE 0 END,
    CASE WHEN 10 * n_repeat_words > 3 * n_words THEN -1 ELSE 0 END,
    CASE WHEN 10 * n_dup_lines > 3 * n_lines THEN -1 ELSE 0 END,
    CASE WHEN 10 * n_upper > 4 * n_words THEN -1 ELSE 0 END,
    CASE WHEN 100 * n_stop < 5 * n_words THEN -1 WHEN 100 * n_stop >= 15 * n_words THEN 1 ELSE 0 END,
    CASE WHEN word_chars > 12 * n_words OR word_chars < 2 * n_words THEN -1 ELSE 0 END,
    CASE WHEN 2 * n_ends >= n_lines THEN 1 ELSE 0 END] END AS v FROM {x}_m),
{x}_pat AS MATERIALIZED (SELECT v, count(*)::DOUBLE AS n FROM {x}_v GROUP BY v),
{x}_p0 AS (SELECT {start} AS p),
{', '.join(em)},
{x}_out AS (SELECT {x}_v.* EXCLUDE (v, _rn), {_post('v', 'p')} AS posterior,
    (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
    NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND {_post('v', 'p')} >= {rules.KEEP_FROM} AS kept FROM {x}_v, {last})
"""


RULES_SQL = f"""WITH {rules_cte()}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
       round(posterior, 6) AS posterior FROM r_out"""
