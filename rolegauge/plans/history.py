"""Questions of a user about stored reports, as whole jobs over tables of texts or typed payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame

from rolegauge.operators import history as H
from rolegauge.sources.reports import export_lines, summaries, with_payload


def recent_history(reports: DataFrame, users: DataFrame) -> DataFrame:
    """The newest reports of every viewer: ``viewer_id, place, id, filename, uploaded_at, score, summary``."""
    recent = H.newest(reports, H.access_pairs(users))
    return recent.select("viewer_id", "place", "id", "filename", "uploaded_at", "score", summaries(recent).alias("summary"))


def dashboards(reports: DataFrame, users: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Totals and trend of every viewer's newest reports."""
    recent = H.newest(reports, H.access_pairs(users))
    return H.dashboard(recent), H.trend(recent)


def report_details(requests: DataFrame, reports: DataFrame, users: DataFrame) -> DataFrame:
    """Asked reports (``report_id, viewer_id``) that exist and may be seen, with typed payloads."""
    return with_payload(H.looked_up(requests, reports, H.access_pairs(users)))


def exported(requests: DataFrame, reports: DataFrame, users: DataFrame) -> DataFrame:
    """All lines of the asked reports."""
    return export_lines(H.looked_up(requests, reports, H.access_pairs(users)).dropDuplicates(["id"]))
