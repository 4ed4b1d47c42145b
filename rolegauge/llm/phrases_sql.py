"""The phrase query as one DuckDB statement: every phrase of up to four words is counted and scored."""

from __future__ import annotations


def statement(top: int = 2000, least: int = 30) -> str:
    return f"""
WITH t AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x FROM documents),
pieces AS (SELECT lang, unnest(regexp_split_to_array(x, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM t),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
places AS (SELECT lang, size, w, unnest(range(1, len(w) - size + 2)) AS i FROM w, range(1, 5) s(size) WHERE len(w) >= size),
f AS MATERIALIZED (
  SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase, count(*) AS a FROM places GROUP BY ALL HAVING size = 1 OR count(*) >= {least}),
totals AS (SELECT lang, sum(a) AS n FROM f WHERE size = 1 GROUP BY lang),
cuts AS (
  SELECT lang, size, phrase, a, unnest(range(1, size)) AS k, string_split(phrase, ' ') AS w FROM f WHERE size > 1),
sides AS (
  SELECT c.*, l.a AS l, r.a AS r, CAST((2000000 * CAST(c.a AS HUGEINT)) // (l.a + r.a) AS BIGINT) AS score
  FROM cuts c JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:k], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[k + 1:], ' ')),
scored AS (
  SELECT lang, size, phrase, a, l, r, score FROM sides QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
spans AS (SELECT lang, size AS whole, a, string_split(phrase, ' ') AS w, part, unnest(range(1, size - part + 2)) AS i FROM f, range(2, 4) p(part) WHERE size > part),
held AS (SELECT lang, array_to_string(w[i:i + part - 1], ' ') AS phrase, max(a) AS more FROM spans GROUP BY ALL),
alive AS (
  SELECT s.* FROM scored s LEFT JOIN held h ON h.lang = s.lang AND h.phrase = s.phrase
  WHERE more IS NULL OR 100 * CAST(more AS HUGEINT) < 80 * CAST(s.a AS HUGEINT))
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM alive) JOIN totals USING (lang)
WHERE rank <= {top}
"""
