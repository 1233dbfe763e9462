"""Skew check: the batch dedupe when one id holds a third of all rows.

Usage: python tools/skew_check.py [sf_dir] [out.md]

Derives a hot-id variant of bronze from ``events`` (every third message gets
the same id, as a replay storm would), runs silver on the uniform and on the
hot-id bronze, and reads from Spark's event log the rows and bytes that cross
the dedupe shuffle and the largest single task's shuffle input. With the
partial WindowGroupLimit before the shuffle, the hot id adds at most one row
per map task to the shuffle instead of a third of the data.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from visitflow.operators import silver  # noqa: E402
from visitflow.session import local_session, materialize  # noqa: E402
from visitflow.sources.fixture import read_bronze  # noqa: E402


def hot_id_bronze(bronze):
    """Every third message carries the id ``hot`` (a third of all rows, one key)."""
    return bronze.withColumn(
        "id", F.when(F.col("delivery_seq") % 3 == 0, F.lit("hot")).otherwise(F.col("id"))
    )


def main(argv: list[str]) -> None:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    out = argv[2] if len(argv) > 2 else None
    log_dir = tempfile.mkdtemp(prefix="visitflow-skew-")
    spark = local_session(
        8,
        shuffle_partitions=16,
        extra={
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": f"file://{log_dir}",
            "spark.eventLog.compress": "false",
            "spark.eventLog.rolling.enabled": "false",
            # Keep the 16 reduce partitions as hashed, so task sizes show the key spread.
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
        },
    )
    # 32 map tasks, read from a checkpoint so the measured jobs hold only the id shuffle.
    bronze = materialize(read_bronze(spark, sf_dir).repartition(32))
    hot = materialize(hot_id_bronze(bronze))
    cases = {
        "uniform ids, dedupe": lambda: silver.clean(bronze).count(),
        "one id = 1/3 of rows, dedupe": lambda: silver.clean(hot).count(),
        "one id = 1/3 of rows, plain shuffle by id (contrast)": lambda: hot.repartition(16, "id")
        .filter(F.col("id").isNotNull())
        .count(),
    }
    rows_out = {}
    for label, run in cases.items():
        spark.sparkContext.setJobDescription(label)
        rows_out[label] = run()
    spark.sparkContext.setJobDescription(None)
    spark.stop()

    stage_case: dict[int, str] = {}
    stats: dict[str, dict[str, float]] = defaultdict(lambda: defaultdict(float))
    for path in glob.glob(f"{log_dir}/**", recursive=True):
        if not os.path.isfile(path):
            continue
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                if ev.get("Event") == "SparkListenerJobStart":
                    desc = (ev.get("Properties") or {}).get("spark.job.description")
                    for sid in ev.get("Stage IDs", []):
                        if desc:
                            stage_case[sid] = desc
                elif ev.get("Event") == "SparkListenerTaskEnd":
                    label = stage_case.get(ev.get("Stage ID"))
                    m = ev.get("Task Metrics") or {}
                    if not label or not m:
                        continue
                    sw = m.get("Shuffle Write Metrics") or {}
                    sr = m.get("Shuffle Read Metrics") or {}
                    s = stats[label]
                    s["rows_shuffled"] += sw.get("Shuffle Records Written", 0)
                    s["bytes_shuffled"] += sw.get("Shuffle Bytes Written", 0)
                    read = sr.get("Remote Bytes Read", 0) + sr.get("Local Bytes Read", 0)
                    s["max_task_read"] = max(s["max_task_read"], read)
                    s["max_task_rows"] = max(s["max_task_rows"], sr.get("Total Records Read", 0))
    lines = [
        "",
        "## Skew check (batch dedupe)",
        "",
        f"`tools/skew_check.py` on `{sf_dir}`: bronze in 32 map tasks (from a checkpoint),",
        "16 reduce partitions without AQE coalescing. Rows are silver rows for the dedupe",
        "cases and rows kept for the contrast case. The contrast row shuffles the hot-id",
        "bronze by id with no partial step: one task then reads the whole hot id.",
        "",
        "| case | rows | rows shuffled | MB shuffled | max task rows read | max task MB read |",
        "| --- | --- | --- | --- | --- | --- |",
    ]
    for label in cases:
        s = stats.get(label, {})
        lines.append(
            f"| {label} | {rows_out[label]} | {int(s.get('rows_shuffled', 0))} | "
            f"{s.get('bytes_shuffled', 0) / 1e6:.2f} | {int(s.get('max_task_rows', 0))} | "
            f"{s.get('max_task_read', 0) / 1e6:.2f} |"
        )
    text = "\n".join(lines) + "\n"
    if out:
        with open(out, "a") as fh:
            fh.write(text)
    print(text)


if __name__ == "__main__":
    main(sys.argv)
