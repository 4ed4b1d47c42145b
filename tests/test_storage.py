"""The shared folder: the session's setting, a temporary one for local sessions, an error elsewhere; written tables."""

from types import SimpleNamespace

import pytest

from rolegauge.storage import materialize, remove, shared_folder


def session(master, named=None):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, other: named), sparkContext=SimpleNamespace(master=master))


def test_folder():
    assert shared_folder(session("spark://host:1", "hdfs://a/b/")) == "hdfs://a/b"
    assert shared_folder(session("local[4]")).startswith("file://")
    for master in ("spark://host:1", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError):
            shared_folder(session(master))


def test_written_tables(spark):
    df = spark.createDataFrame([(1, None), (2, "b")], "n int, t string")
    table = materialize(df, "test")
    assert table.schema == df.schema and sorted(map(tuple, table.collect())) == [(1, None), (2, "b")]
    remove(table)
    with pytest.raises(Exception, match="(?i)not exist|FileNotFound"):
        table.collect()
