"""Headline queries at one scale; prints one JSON line.

BENCH_SF_DIR is the table folder, BENCH_CPUS the number of local cores, BENCH_RUNS the
measured runs per query after one warm-up (the median counts).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from streamlake.plans.queries import QUERIES  # noqa: E402
from streamlake.session import local_session  # noqa: E402

HEADLINE = (
    "gate_valid",
    "gate_invalid",
    "contract_violations",
    "dedup_events",
    "fact_stream",
    "dim_artist",
    "dim_track",
    "daily_listening_metrics",
    "constraint_report",
    "upsert_fact",
    "daily_listening_minutes",
    "top10_artists",
    "platform_distribution",
    "skip_rate",
    "log_metrics",
    "metric_alarms",
    "row_level_access",
    "order_plays_dedup",
    "order_plays_duplicate_keys",
    "order_plays_daily_metrics",
    "order_plays_top_artists",
    "upsert_idempotent",
    "lake_pipeline",
    "stream_gate",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session("bench", cpus, int(cpus))
    seconds = {}
    for name in names:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    result = {
        "metric": "headline queries, sum of median seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    spark.stop()
    print(json.dumps(result), flush=True)


if __name__ == "__main__":
    main()
