"""Build a plan once per session and folder. Only the lazy plan is kept, never data."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession


KEPT: list[dict] = []


def forget() -> None:
    """Build every plan anew from now on: for measurements, and when the files have changed."""
    for known in KEPT:
        known.clear()


def planned(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    known: dict[str, tuple[SparkSession, DataFrame]] = {}
    KEPT.append(known)

    @wraps(build)
    def plan(spark: SparkSession, folder: str) -> DataFrame:
        session, df = known.get(folder, (None, None))
        if session is not spark:
            df = build(spark, folder)
            known[folder] = (spark, df)
        return df

    return plan
