"""A sample of the registered queries next to their SQL, on the smallest tables."""

import duckdb
import pytest

from compare import TABLES, rows_of
from rolegauge.checks.registry import oracle_sql, queries

SAMPLE = ["bullet_rewrites", "criteria_reasons", "recommendations", "report_lines", "score_progress", "rate_limit", "validate_scan"]


@pytest.fixture(scope="module")
def db(folder):
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, folder, db, name):
    df = queries()[name](spark, folder)
    result = db.execute(oracle_sql()[name])
    expected = rows_of([c[0] for c in result.description], result.fetchall())
    assert expected and rows_of(df.columns, [tuple(r) for r in df.collect()]) == expected


def test_every_query_has_a_statement():
    assert set(queries()) - set(oracle_sql()) == {"report_roundtrip"}
