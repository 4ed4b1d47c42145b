"""Sliding-window limit: an attempt is accepted iff fewer than ``limit`` accepted attempts of its key are younger
than the window. Rejected attempts do not count.

Every decision depends on the ones before it, and one key may hold a large part of all attempts. The table is
therefore range-partitioned by (key, time), which cuts a hot key into many partitions of equal size. Partitions are
judged at the same time, each as if nothing came before; then only the accepted times at the end of a partition (at
most ``limit`` numbers, none older than the window) are handed to the next one. No accepted attempt reaches over a pause
as long as the window, so the end of a partition with such a pause, or with another key, does not depend on its start:
it is final after the first pass. Only partitions without one are judged again when their start changes, and a round
computes no other partition. No task ever holds more than one Arrow batch of a key.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from rolegauge.functions.text import strip
from rolegauge.session import ensure_checkpoint_dir, shuffle_partitions


def judge(times: np.ndarray, accepted: deque, limit: int, window: int) -> np.ndarray:
    """Decide sorted ``times`` of one key; ``accepted`` holds its last accepted times and is updated.

    Jumps from one accepted attempt to the next, so rejected attempts cost nothing.
    """
    result = np.zeros(len(times), dtype=bool)
    at = 0
    while limit > 0 and at < len(times):
        if len(accepted) == limit:
            at = max(at, int(np.searchsorted(times, accepted[0] + window, side="left")))
            if at >= len(times):
                break
            accepted.popleft()
        accepted.append(int(times[at]))
        result[at] = True
        at += 1
    return result


def _judged(batches: Iterator[pd.DataFrame], starts: dict, limit: int, window: int, ends: bool) -> Iterator[pd.DataFrame]:
    """Judge the sorted rows of one partition; yields decided rows, or one row with the state at the end. ``cut`` tells that
    the end does not depend on the start."""
    key, first_key, part, accepted = None, None, None, deque()
    first_at, last_at, cut = None, None, False
    for batch in batches:
        if batch.empty:
            continue
        decided = np.zeros(len(batch), dtype=bool)
        keys, times = batch["_key"].to_numpy(), batch["_at"].to_numpy()
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(batch)]
        for begin, end in zip(cuts, cuts[1:]):
            if keys[begin] != key:
                if part is None:
                    part, first_key, first_at = int(batch["_part"].iloc[0]), keys[begin], int(times[begin])
                    accepted = deque(starts.get(part, ()))
                else:
                    accepted, cut = deque(), True
                key = keys[begin]
            elif times[begin] - last_at >= window:
                cut = True
            cut = cut or bool((np.diff(times[begin:end]) >= window).any())
            last_at = int(times[end - 1])
            decided[begin:end] = judge(times[begin:end], accepted, limit, window)
        if not ends:
            yield batch.drop(columns=["_key", "_at", "_part"]).assign(accepted=decided)
    if ends and part is not None:
        row = {"part": part, "first_key": first_key, "last_key": key, "first_at": first_at, "cut": cut, "state": list(accepted)}
        yield pd.DataFrame([row])


def client_key(forwarded: Column, address: Column) -> Column:
    """The client of an attempt: the first forwarded address when there is one, else the direct one."""
    return strip(F.get(F.split(F.coalesce(forwarded, F.nullif(address, F.lit("")), F.lit("local")), ","), F.lit(0)))


def rate_limit(
    attempts: DataFrame, keys: list[str], ts: str, order: str, limit: int, seconds: int, counted: Column | None = None
) -> DataFrame:
    """``attempts`` with a column ``accepted``. ``order`` breaks ties of equal times.

    Attempts that are not ``counted`` (a mere page view) are accepted and leave no trace.
    """
    if counted is not None:
        free = attempts.filter(~F.coalesce(counted, F.lit(False))).withColumn("accepted", F.lit(True))
        return rate_limit(attempts.filter(counted), keys, ts, order, limit, seconds).unionByName(free)
    spark = attempts.sparkSession
    ensure_checkpoint_dir(spark)
    window = seconds * 1_000_000
    shaped = attempts.withColumn("_key", F.to_json(F.struct(*keys))).withColumn("_at", F.unix_micros(F.col(ts).cast("timestamp")))
    placed = ["_key", "_at", order]
    # The checkpoint fixes the partition borders; later rounds rely on them.
    ordered = shaped.repartitionByRange(shuffle_partitions(spark), *placed).sortWithinPartitions(*placed).checkpoint()
    numbered = ordered.withColumn("_part", F.spark_partition_id())

    ends: dict[int, Row] = {}
    starts: dict[int, list[int]] = {}
    pending: list[int] | None = None
    while pending is None or pending:
        current = dict(starts)
        found = numbered.select("_key", "_at", "_part").mapInPandas(
            lambda batches: _judged(batches, current, limit, window, ends=True),
            "part int, first_key string, last_key string, first_at bigint, cut boolean, state array<bigint>",
        )
        # One short row per partition; a later round computes the pending ones only.
        ends |= {row["part"]: row for row in spark.sparkContext.runJob(found.rdd, list, pending)}
        parts, fresh = sorted(ends), {}
        for before, part in zip(parts, parts[1:]):
            if ends[part]["first_key"] == ends[before]["last_key"]:
                reaching = [t for t in ends[before]["state"] if ends[part]["first_at"] - t < window]
                if reaching:
                    fresh[part] = reaching
        pending = [part for part in parts if fresh.get(part) != starts.get(part) and not ends[part]["cut"]]
        starts = fresh

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in attempts.schema.fields)
    final = dict(starts)
    return numbered.mapInPandas(
        lambda batches: _judged(batches, final, limit, window, ends=False), f"{fields}, accepted boolean"
    )
