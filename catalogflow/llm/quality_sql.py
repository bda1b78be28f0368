"""The SQL of op13_quality_rules."""

from .quality import GAP, RULES, SYMBOL, WINDOW, WORD


def _q(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, regexp_extract_all(t, {_q(WORD)}) AS words FROM d),
windows AS (
  SELECT r, i, list_slice(words, i, i + {WINDOW - 1}) AS x
  FROM (SELECT r, words, unnest(range(1, len(words) - {WINDOW - 2})) AS i FROM w)
),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, x) AS n FROM windows) WHERE n > 1),
repeats AS (
  SELECT r, sum(least({WINDOW}, coalesce(after - i, {WINDOW}))) AS n
  FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS after FROM twice) GROUP BY r
),
lines AS (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d),
counted AS (
  SELECT r, line, len(regexp_extract_all(line, {_q(WORD)})) AS n, length(regexp_replace(line, {_q(GAP)}, '', 'g')) AS c,
    len(regexp_extract_all(line, {_q(RULES.marks)})) AS marks, len(regexp_extract_all(line, {_q(RULES.separators)})) AS signs,
    right(regexp_replace(line, {_q(GAP + '$')}, ''), 1) AS ending
  FROM lines WHERE regexp_matches(line, {_q(WORD)})
),
judged AS (
  SELECT r, count(*) - count(DISTINCT line) AS dup,
    sum(c) FILTER (WHERE NOT regexp_matches(ending, {_q(RULES.ending)}) OR marks * 100 >= n * {RULES.marks_percent}
      OR (signs >= 2 AND signs * 100 >= n * {RULES.separators_percent})
      OR (n <= {RULES.boilerplate_words} AND regexp_matches(lower(line), {_q(RULES.boilerplate)}))) AS lost
  FROM counted GROUP BY r
),
base AS (
  SELECT w.doc_id, len(words) AS n, length(regexp_replace(t, {_q(GAP)}, '', 'g')) AS chars, len(regexp_extract_all(t, {_q(SYMBOL)})) AS symbols,
    coalesce(dup, 0) AS dup, coalesce(repeats.n, 0) AS rep, coalesce(lost, 0) AS lost
  FROM w LEFT JOIN repeats USING (r) LEFT JOIN judged USING (r)
)
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(chars AS BIGINT) AS word_chars, CAST(symbols AS BIGINT) AS n_symbols,
  CAST(dup AS BIGINT) AS n_dup_lines, CAST(rep AS BIGINT) AS n_repeat_words, n < 20 OR 100 * rep > 30 * n AS base_failed,
  NOT (n < 20 OR 100 * rep > 30 * n) AND lost * 100 <= chars * {RULES.max_lost_percent} AS kept
FROM base
"""
