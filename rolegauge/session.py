"""Session defaults. A cluster's own settings win: nothing here overrides a value that is already set."""

from __future__ import annotations

from pyspark.sql import SparkSession

from rolegauge.storage import shared_folder


def local_session(cores: int | str = "*", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("rolegauge")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        # Recording the call site of every Column doubles the time a large plan takes to build.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the cluster names. Without one a local session takes a temporary folder; a cluster raises an error."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def shuffle_partitions(spark: SparkSession) -> int:
    """The session's own number, for shuffles whose partitions must not be merged afterwards."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
