"""The vector code query as one DuckDB statement: all entries are compared, every round is a table expression of its own."""

from __future__ import annotations

# Those of the checked query.
PARTS, ENTRIES, ROUNDS = 16, 64, 2


def statement() -> str:
    steps = [
        f"""kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS rid, vec_id, label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v, len(embedding) // {PARTS} AS w
  FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""p AS MATERIALIZED (
  SELECT rid, CAST(part AS BIGINT) AS part, v[part * w + 1:part * w + w] AS y, w FROM kept, range({PARTS}) t(part))""",
        f"b0 AS MATERIALIZED (SELECT part, rid - 1 AS entry, y FROM p WHERE rid <= {ENTRIES})",
    ]
    for i in range(ROUNDS + 1):
        steps.append(
            f"""a{i} AS MATERIALIZED (
  SELECT rid, part, any_value(p.y) AS y, min(list_sum(list_transform(range(1, w + 1), lambda i: (p.y[i] - b.y[i]) * (p.y[i] - b.y[i]))) * {ENTRIES} + entry) AS m
  FROM p JOIN b{i} b USING (part) GROUP BY rid, part)"""
        )
        if i < ROUNDS:
            steps.append(
                f"""u{i} AS (SELECT part, CAST(m AS BIGINT) % {ENTRIES} AS entry, unnest(y) AS x, unnest(range(len(y))) AS pos FROM a{i}),
c{i} AS (SELECT part, entry, pos, CAST(floor(CAST(sum(x) AS DOUBLE) / count(*)) AS BIGINT) AS x FROM u{i} GROUP BY ALL),
d{i} AS (SELECT part, entry, list(x ORDER BY pos) AS y FROM c{i} GROUP BY ALL),
b{i + 1} AS MATERIALIZED (SELECT part, entry, coalesce(d.y, b.y) AS y FROM b{i} b LEFT JOIN d{i} d USING (part, entry))"""
            )
    return (
        "WITH " + ",\n".join(steps) + f""",
sums AS (
  SELECT rid, string_agg(printf('%02x', CAST(m AS BIGINT) % {ENTRIES}), '' ORDER BY part) AS code, CAST(sum(CAST(m AS BIGINT) // {ENTRIES}) AS BIGINT) AS error
  FROM a{ROUNDS} GROUP BY rid),
parts AS (SELECT part, entry, unnest(y) AS x, unnest(range(len(y))) AS pos FROM b{ROUNDS}),
digest AS (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, pos)) AS codebooks_sha256 FROM parts)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN sums USING (rid), digest"""
    )
