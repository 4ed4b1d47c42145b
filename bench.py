"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 3, after one
warm-up). Each run builds the plan again, with everything that it writes to the shared folder, and writes the whole result to the no-op sink.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rolegauge.checks import match_queries as M  # noqa: E402
from rolegauge.checks import score_queries as S  # noqa: E402
from rolegauge.checks import stored_queries as H  # noqa: E402
from rolegauge.checks.plans import forget  # noqa: E402
from rolegauge.session import local_session  # noqa: E402

HEADLINE = {
    "scan_scores": S.scan_scores,
    "recommendations": M.recommendations,
    "catalog_match": M.catalog_match,
    "report_build": M.report_build,
    "dashboard": H.dashboard,
    "score_progress": H.score_progress,
    "report_lines": H.report_lines,
    "rate_limit": H.rate_limited,
}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cores, spark__sql__shuffle__partitions=str(2 * int(cores)))
    times: dict[str, float] = {}
    for name, query in HEADLINE.items():
        spent = []
        for _ in range(runs + 1):
            forget()
            begin = time.time()
            query(spark, folder).write.format("noop").mode("overwrite").save()
            spent.append(time.time() - begin)
        times[name] = round(statistics.median(spent[1:]), 3)
        print(name, [round(s, 2) for s in spent], file=sys.stderr, flush=True)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {"metric": "headline queries, total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": scale}
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
