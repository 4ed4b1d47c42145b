"""The sliding-window limit as batch and stream, and the continuous scan."""

import random
from collections import deque
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from rolegauge.operators.rate_limit import client_key, judge, rate_limit
from rolegauge.plans.scan import scan
from rolegauge.sources.catalog import default_catalog
from rolegauge.streaming.attempts import limit_stream
from rolegauge.streaming.scan_stream import RANGES, ids_before, record_ids, start_scan

START = datetime(2025, 1, 1)


def brute(rows, limit, seconds):
    kept, result = {}, {}
    for number, key, at in sorted(rows, key=lambda r: (r[2], r[0])):
        recent = [t for t in kept.get(key, []) if (at - t).total_seconds() < seconds]
        result[number] = len(recent) < limit
        kept[key] = [*recent, at] if result[number] else recent
    return result


def attempts(count, seed, hot):
    rng = random.Random(seed)
    return [
        (n, "hot" if rng.random() < hot else f"k{rng.randint(0, 5)}", START + timedelta(seconds=rng.randint(0, 4000)))
        for n in range(count)
    ]


def frame(spark, rows):
    return spark.createDataFrame(rows, "n bigint, key string, ts timestamp")


@pytest.mark.parametrize("limit, seconds, hot", [(1, 60, 0.9), (3, 300, 0.6), (12, 300, 1.0), (0, 60, 0.5)])
def test_batch_equals_brute_force(spark, limit, seconds, hot):
    rows = attempts(600, limit, hot)
    got = rate_limit(frame(spark, rows), ["key"], "ts", "n", limit, seconds)
    assert {r["n"]: r["accepted"] for r in got.collect()} == brute(rows, limit, seconds)


def test_equal_times_and_the_window_edge():
    times = np.array([0, 0, 0, 60, 60, 119, 120])
    assert judge(times, deque(), 2, 60).tolist() == [True, True, False, True, True, False, True]


def test_hot_key_is_spread_over_partitions(spark):
    rows = [(n, "hot", START + timedelta(seconds=n)) for n in range(2000)]
    got = rate_limit(frame(spark, rows), ["key"], "ts", "n", 5, 300)
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 1 and max(sizes) < 1500
    assert {r["n"]: r["accepted"] for r in got.collect()} == brute(rows, 5, 300)


@pytest.mark.parametrize("keep", [None, 3600])
def test_stream_equals_batch(spark, tmp_path, keep):
    rows = sorted(attempts(200, 5, 0.5), key=lambda r: r[2])
    source = str(tmp_path / "in")
    for part in (rows[:90], rows[90:]):
        frame(spark, part).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema("n bigint, key string, ts timestamp").parquet(source)
    limited = limit_stream(stream, ["key"], "ts", "n", 3, 300, keep)
    query = (
        limited.writeStream.format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    )
    query.awaitTermination(120)
    got = {r["n"]: r["accepted"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == brute(rows, 3, 300)


def test_late_attempts_keep_a_verdict(spark, tmp_path):
    times = [0, 100, 90_000, 50, 90_001]
    rows = [(n, "k", START + timedelta(seconds=t), "POST" if n != 1 else "GET") for n, t in enumerate(times)]
    source = str(tmp_path / "in")
    for row in rows:
        spark.createDataFrame([row], "n bigint, key string, ts timestamp, method string").coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema("n bigint, key string, ts timestamp, method string").option("maxFilesPerTrigger", 1).parquet(source)
    limited = limit_stream(stream, ["key"], "ts", "n", 2, 300, keep_seconds=300, counted=F.col("method") != "GET")
    query = (
        limited.writeStream.format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    )
    query.awaitTermination(120)
    got = {r["n"]: r["accepted"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert set(got) == {0, 1, 2, 3, 4} and got[1]


def test_continuous_scan_equals_batch(spark, tmp_path):
    shape = "doc_id bigint, raw_text string, ext string, title string, description string, user_id bigint, filename string, uploaded_at timestamp"
    rows = [(n, f"python sql with {n} years of experience", "txt", "Data Analyst", None, 1, "a.txt", START) for n in range(6)]
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame(rows[:4], shape).write.parquet(source)
    catalog = default_catalog(spark)
    stream = spark.readStream.schema(shape).parquet(source)
    for _ in range(2):
        start_scan(stream, catalog, out, str(tmp_path / "state"), 2026).awaitTermination(200)
        spark.createDataFrame(rows[4:], shape).write.mode("append").parquet(source) if _ == 0 else None
    stored = spark.read.parquet(out)
    expected = scan(spark.createDataFrame(rows, shape), catalog, 2026)
    assert sorted(map(tuple, stored.select("doc_id", "score").collect())) == sorted(map(tuple, expected.select("doc_id", "score").collect()))
    assert stored.select("id").distinct().count() == 6
    assert {(r["batch"], r["id"]) for r in stored.groupBy("batch").agg(F.max("id").alias("id")).collect()} == {(0, 4), (1, 6)}
    assert spark.read.parquet(f"{out}/{RANGES}/after=1").first()["id"] == 6


def test_a_micro_batch_reads_one_record(spark, tmp_path):
    out = str(tmp_path / "out")
    ids = lambda rows, n: spark.createDataFrame([(i,) for i in rows], "id bigint").write.mode("overwrite").parquet(f"{out}/batch={n}")
    last = lambda n: ids_before(spark, out, n).agg(F.max("id")).first()[0]
    assert last(0) is None and last(3) is None
    read = []
    for n in range(6):
        known = ids_before(spark, out, n)
        read.append(len(known.inputFiles()))
        ids([] if n == 3 else [2 * n + 1, 2 * n + 2], n)
        record_ids(spark, out, n, known)
    assert read[1:] == [1] * 5 and last(4) == 6 and last(6) == 12
    ids([9, 10], 4)  # repeated after a failure
    record_ids(spark, out, 4, ids_before(spark, out, 4))
    assert last(5) == 10
    old = str(tmp_path / "old")  # written before there were records
    spark.createDataFrame([(5,), (7,)], "id bigint").write.parquet(f"{old}/batch=0")
    assert ids_before(spark, old, 1).agg(F.max("id")).first()[0] == 7
    assert set(spark.read.parquet(out).columns) == {"id", "batch"}


def test_client_key_and_uncounted_attempts(spark):
    df = spark.createDataFrame([(" 1.2.3.4 , 5.6.7.8", "9.9.9.9"), (None, "9.9.9.9"), (None, None)], "f string, a string")
    assert [r[0] for r in df.select(client_key(F.col("f"), F.col("a"))).collect()] == ["1.2.3.4", "9.9.9.9", "local"]
    rows = [(n, "k", START + timedelta(seconds=n), "GET" if n % 2 else "POST") for n in range(8)]
    seen = spark.createDataFrame(rows, "n bigint, key string, ts timestamp, method string")
    got = rate_limit(seen, ["key"], "ts", "n", 2, 60, counted=F.col("method") != "GET")
    assert {r["n"] for r in got.filter("accepted").collect()} == {0, 1, 2, 3, 5, 7}
