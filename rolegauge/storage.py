"""Intermediate data in the folder that driver and executors share.

The folder is the session's `spark.checkpoint.dir`. Only a local session (tests) may go without: there one process does everything,
so a temporary folder is as good. On a cluster a missing setting is an error.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

LOCAL_FOLDER: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The shared folder's URI, without a slash at the end."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if "at" not in LOCAL_FOLDER:
        LOCAL_FOLDER["at"] = "file://" + tempfile.mkdtemp(prefix="rolegauge-shared-")
    return LOCAL_FOLDER["at"]


def new_folder(spark: SparkSession, label: str) -> str:
    """The URI of a folder that does not exist yet."""
    return f"{shared_folder(spark)}/rolegauge-{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """Write the rows as Parquet in the shared folder and read them from there: the lineage ends, and lost executors lose nothing.
    Shuffle files of the job that wrote them are no longer needed and are removed at once where Spark can do so."""
    spark = df.sparkSession
    path = new_folder(spark, label)
    cleanup = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(cleanup, "false")
    spark.conf.set(cleanup, "true")
    try:
        df.write.parquet(path, compression=compression)
    finally:
        spark.conf.set(cleanup, before)
    return spark.read.schema(df.schema).parquet(path)


def remove(df: DataFrame) -> None:
    """Delete the folder that `materialize` wrote. Nothing that still reads `df` may run afterwards."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
