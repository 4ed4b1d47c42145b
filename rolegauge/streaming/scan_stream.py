"""Continuous scan: every arriving document is scored and matched once and its report appended."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rolegauge.lexicon import DEFAULT, Lexicon
from rolegauge.operators.catalog_match import prepare
from rolegauge.plans.scan import scan
from rolegauge.schemas import path_exists
from rolegauge.sources.reports import report_ids


RANGES = "_id_ranges"  # a leading underscore keeps the folder out of the report table


def ids_before(spark: SparkSession, out: str, batch_id: int) -> DataFrame:
    """``id``: the last report id given out before a micro-batch, or no row.

    Each micro-batch leaves one small record, and only that of the one before is read. A table whose earlier micro-batches left none
    is asked for its ids.
    """
    none = spark.createDataFrame([], "id bigint")
    if not batch_id:
        return none
    record = f"{out}/{RANGES}/after={batch_id - 1}"
    if path_exists(spark, record):
        return spark.read.schema("id bigint").parquet(record)
    if not path_exists(spark, out):
        return none
    stored = spark.read.option("basePath", out).parquet(out)
    return stored.filter(F.col("batch") < batch_id).select("id")


def record_ids(spark: SparkSession, out: str, batch_id: int, known: DataFrame) -> None:
    """Write the record of a micro-batch from its own reports and the record before it."""
    own = spark.read.parquet(f"{out}/batch={batch_id}").select("id")
    last = own.agg(F.max("id").alias("id")).union(known.agg(F.max("id").alias("id"))).agg(F.max("id").alias("id"))
    last.filter("id is not null").write.mode("overwrite").parquet(f"{out}/{RANGES}/after={batch_id}")


def start_scan(
    docs: DataFrame, catalog: DataFrame, out: str, checkpoint: str, as_of_year: int, lex: Lexicon = DEFAULT,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Run the batch plan on every micro-batch of ``docs``.

    A micro-batch writes to its own folder and overwrites it when it is repeated after a failure, so each document
    is reported once. Report ids follow those of the micro-batches before it, as in the batch form (``report_ids``);
    a repeated micro-batch reads the same record and gets the same ids.
    """

    ready = prepare(catalog, lex)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        known = ids_before(spark, out, batch_id)
        ids = report_ids(batch, "doc_id", known)
        reports = scan(batch, ready, as_of_year, lex).join(ids, "doc_id")
        reports.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        record_ids(spark, out, batch_id, known)

    return (
        docs.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
