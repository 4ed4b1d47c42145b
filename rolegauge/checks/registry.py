"""All checked queries: name -> (Spark query, DuckDB statement)."""

from __future__ import annotations

from rolegauge.checks import match_queries, score_queries, stored_queries, text_queries
from rolegauge.checks.sql.base import compose

ENTRIES = {
    **text_queries.ENTRIES,
    **score_queries.ENTRIES,
    **match_queries.ENTRIES,
    **stored_queries.ENTRIES,
}


def queries() -> dict:
    return {name: query for name, (query, _) in ENTRIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: compose(sql) for name, (_, sql) in ENTRIES.items() if sql}
