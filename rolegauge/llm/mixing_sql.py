"""The mixing query as one DuckDB statement: the level of each margin by sorted sums, every step of the fit a table expression of its own."""

from __future__ import annotations

# Those of the checked query.
POWERS = {"source": 0.7, "lang": 0.7, "topic": 0.5}
SWEEPS = 15
LEAST_SHARE = 0.01


def statement() -> str:
    parts = [
        """d AS MATERIALIZED (
  SELECT doc_id, coalesce(source, '(none)') AS source, coalesce(lang, '(none)') AS lang, n AS n_tokens,
         CASE WHEN text LIKE '% | %' THEN 'listing' WHEN text LIKE '%!!%' THEN 'shouting'
              WHEN regexp_matches(coalesce(text, ''), '[#$%&*]{3}') THEN 'marked'
              WHEN n < 100 THEN 'short' WHEN n < 1000 THEN 'medium' ELSE 'long' END AS topic
  FROM (SELECT *, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS n FROM documents))""",
        """cells AS MATERIALIZED (
  SELECT source, lang, topic, CAST(sum(n_tokens) AS DOUBLE) AS tokens FROM d GROUP BY ALL)""",
    ]
    for margin, power in POWERS.items():
        parts.append(
            f"""t_{margin} AS MATERIALIZED (
  SELECT {margin}, own, p / sum(p) OVER () AS share FROM (
    SELECT {margin}, sum(tokens) AS own, pow(sum(tokens), {power}) AS p FROM cells GROUP BY 1 HAVING sum(tokens) > 0))"""
        )
    limits = " UNION ALL ".join(f"SELECT own / share AS most FROM t_{m} WHERE share >= {LEAST_SHARE}" for m in POWERS)
    parts.append(f"""ask AS MATERIALIZED (
  SELECT least((SELECT sum(tokens) FROM cells), (SELECT min(most) FROM ({limits}))) AS asked, (SELECT sum(tokens) FROM cells) AS total)""")
    for margin in POWERS:
        order = f"ORDER BY own / share, {margin}"
        parts.append(
            f"""l_{margin} AS MATERIALIZED (
  SELECT *, own / share AS ratio, (asked - coalesce(sum(own) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(share) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM t_{margin}, ask),
w_{margin} AS MATERIALIZED (
  SELECT {margin}, least(own, share * coalesce((SELECT max(level) FROM l_{margin} WHERE level <= ratio), 'inf'::DOUBLE)) AS wanted FROM t_{margin})"""
        )
    parts.append("c0 AS MATERIALIZED (SELECT source, lang, topic, tokens, asked / total AS f FROM cells, ask WHERE tokens > 0)")
    step = 0
    for _ in range(SWEEPS):
        for margin in POWERS:
            parts.append(
                f"""c{step + 1} AS MATERIALIZED (
  SELECT c.source, c.lang, c.topic, tokens, CASE WHEN now > 0 THEN f * wanted / now ELSE 0 END AS f
  FROM c{step} c JOIN (SELECT {margin}, sum(tokens * least(1, f)) AS now FROM c{step} GROUP BY 1) USING ({margin}) JOIN w_{margin} USING ({margin}))"""
            )
            step += 1
    return (
        "WITH " + ",\n".join(parts) + f""",
q AS (SELECT cells.source, cells.lang, cells.topic, cells.tokens, CASE WHEN f IS NULL THEN 0 ELSE least(1, f) END AS prob
  FROM cells LEFT JOIN c{step} c ON c.source = cells.source AND c.lang = cells.lang AND c.topic = cells.topic)
SELECT doc_id, topic, n_tokens, round(tokens * prob, 3) AS cell_weight, round(prob, 9) AS probability,
       CAST(('0x' || md5(coalesce(CAST(doc_id AS VARCHAR), ''))[1:8]) AS BIGINT) / 4294967296.0 < prob AS sampled
FROM d JOIN q USING (source, lang, topic)"""
    )
