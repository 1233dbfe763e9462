"""Benchmark: run the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma-separated subset of the headline queries; default all),
BENCH_REPEAT (default 2; best-of-N per query, so JIT warm-up and GC noise
do not dominate sub-second queries).

Each query runs to completion through the ``noop`` sink (the whole plan
executes, nothing is collected to the driver). One warm-up run of a batch
and of a streaming query loads the JVM code paths first.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from visitflow.plans.catalog import QUERIES  # noqa: E402
from visitflow.session import local_session  # noqa: E402

HEADLINE = [
    "bronze_decode",
    "silver_visits",
    "silver_row_count",
    "gold_severity_summary",
    "gold_age_group_summary",
    "gold_daily_trends",
    "gold_top_doctors",
    "gold_diagnosis_summary",
    "gold_one_pass",
    "kpi_summary",
    "gold_roundtrip",
    "stream_silver",
    "stream_gold_severity",
    "stream_gold_all",
    "stream_gold_upsert",
    "stream_gold_top",
    "gold_incremental",
    "stream_silver_indexed",
]


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    subset = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    names = [q for q in HEADLINE if q in subset] if subset else HEADLINE
    # One shuffle partition per core: AQE coalesces batch shuffles anyway, but streaming
    # state stores keep the count they start with, one task each per micro-batch.
    spark = local_session(cpus, shuffle_partitions=cpus, app_name="visitflow-bench")
    # Warm-up: load the batch and the streaming code paths into the JVM once.
    _run(QUERIES["silver_row_count"](spark, sf_dir))
    if any(n.startswith("stream_") for n in names):
        _run(QUERIES["stream_silver"](spark, sf_dir))
    timings: dict[str, float] = {}
    for name in names:
        best = None
        for _ in range(repeat):
            t0 = time.perf_counter()
            _run(QUERIES[name](spark, sf_dir))
            elapsed = time.perf_counter() - t0
            best = elapsed if best is None else min(best, elapsed)
        timings[name] = round(best, 3)
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(m.group(1)) if m else sf_dir,
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
