"""Per-query execution metrics from Spark's event log (writes STAGES.md).

Usage: python tools/stage_report.py [sf_dir] [out.md]

Runs every registered batch query through the ``noop`` sink with a job
description, writes the event log to a fresh scratch folder, and sums per
query: input records read, shuffle bytes written, memory/disk spill, tasks and
the largest single task's shuffle read (a skew signal).
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from visitflow.plans.catalog import QUERIES  # noqa: E402
from visitflow.session import local_session  # noqa: E402


def _mb(n: float) -> str:
    return f"{n / 1e6:.2f}"


def main(argv: list[str]) -> None:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    out = argv[2] if len(argv) > 2 else None
    log_dir = tempfile.mkdtemp(prefix="visitflow-eventlog-")
    spark = local_session(
        8,
        shuffle_partitions=16,
        extra={
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": f"file://{log_dir}",
            "spark.eventLog.compress": "false",
            "spark.eventLog.rolling.enabled": "false",
        },
    )
    names = [n for n in QUERIES if not n.startswith("stream_")]
    for name in names:
        spark.sparkContext.setJobDescription(name)
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.sparkContext.setJobDescription(None)
    spark.stop()

    stage_query: dict[int, str] = {}
    stats: dict[str, dict[str, float]] = defaultdict(lambda: defaultdict(float))
    for path in glob.glob(f"{log_dir}/**", recursive=True):
        if not os.path.isfile(path):
            continue
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    desc = (ev.get("Properties") or {}).get("spark.job.description")
                    if desc:
                        for sid in ev.get("Stage IDs", []):
                            stage_query[sid] = desc
                elif kind == "SparkListenerTaskEnd":
                    name = stage_query.get(ev.get("Stage ID"))
                    m = ev.get("Task Metrics") or {}
                    if not name or not m:
                        continue
                    s = stats[name]
                    s["tasks"] += 1
                    s["input_rows"] += (m.get("Input Metrics") or {}).get("Records Read", 0)
                    sw = (m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
                    s["shuffle_write"] += sw
                    sr = m.get("Shuffle Read Metrics") or {}
                    read = sr.get("Remote Bytes Read", 0) + sr.get("Local Bytes Read", 0)
                    s["max_task_read"] = max(s["max_task_read"], read)
                    s["spill_mem"] += m.get("Memory Bytes Spilled", 0)
                    s["spill_disk"] += m.get("Disk Bytes Spilled", 0)
    lines = [
        "# Execution metrics of the registered queries",
        "",
        f"Generated by `tools/stage_report.py` on `{sf_dir}`, local[8], 16 shuffle partitions,",
        "AQE on. Sizes in MB; input rows count every scan (a round trip reads its own output). `max task shuffle read` is the largest shuffle input of a single",
        "task (a skew signal). Streaming queries are not listed (their work is per micro-batch).",
        "",
        "| query | tasks | input rows | shuffle written | max task shuffle read | spill (mem/disk) |",
        "| --- | --- | --- | --- | --- | --- |",
    ]
    for name in names:
        s = stats.get(name, {})
        lines.append(
            f"| {name} | {int(s.get('tasks', 0))} | {int(s.get('input_rows', 0))} | "
            f"{_mb(s.get('shuffle_write', 0))} | {_mb(s.get('max_task_read', 0))} | "
            f"{_mb(s.get('spill_mem', 0))}/{_mb(s.get('spill_disk', 0))} |"
        )
    text = "\n".join(lines) + "\n"
    if out:
        with open(out, "w") as fh:
            fh.write(text)
    print(text)


if __name__ == "__main__":
    main(sys.argv)
