"""The sliding-window limit on a stream of attempts."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from rolegauge.operators.rate_limit import judge


def limit_stream(
    attempts: DataFrame, keys: list[str], ts: str, order: str, limit: int, seconds: int, keep_seconds: int | None = None,
    counted: Column | None = None,
) -> DataFrame:
    """Keys, time, order column and ``accepted`` for every attempt, however late it comes.

    The state of a key is its last accepted times, at most ``limit`` numbers. Attempts are judged against the state
    at arrival; inside one micro-batch they are taken in time order, with no other columns in memory. On input that
    arrives in time order the result equals the batch form. With ``keep_seconds`` the state of a key is dropped when
    nothing has come for that long by the clock (the window at least). No watermark is set, so no row is filtered.
    Attempts that are not ``counted`` are accepted and leave no trace.
    """
    window = seconds * 1_000_000
    types = dict(attempts.dtypes)
    fields = ", ".join(f"`{name}` {types[name]}" for name in [*keys, ts, order])
    judged = F.lit(True) if counted is None else F.coalesce(counted, F.lit(False))
    source = attempts.select(*keys, ts, order, judged.alias("_counted"))

    def decide(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        accepted = deque(state.get[0] if state.exists else ())
        rows = pd.concat(list(batches), ignore_index=True).sort_values([ts, order], ignore_index=True)
        times = rows[ts].to_numpy(dtype="datetime64[us]").astype("int64")
        counts = rows["_counted"].to_numpy(dtype=bool)
        decided = np.ones(len(rows), dtype=bool)
        decided[counts] = judge(times[counts], accepted, limit, window)
        state.update((list(accepted),))
        if keep_seconds:
            state.setTimeoutDuration(1000 * max(keep_seconds, seconds))
        yield rows.assign(accepted=decided)[[*keys, ts, order, "accepted"]]

    return source.groupBy(*keys).applyInPandasWithState(
        decide,
        f"{fields}, accepted boolean",
        "accepted array<bigint>",
        "append",
        GroupStateTimeout.ProcessingTimeTimeout if keep_seconds else GroupStateTimeout.NoTimeout,
    )
