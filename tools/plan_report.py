"""Summarise the physical plan of every registered batch query (writes PLANS.md).

Usage: python tools/plan_report.py [sf_dir] [out.md]

Counts per query: parquet scans, shuffles by kind, map-side partial steps
(partial aggregates, partial window limits), top-k nodes, Expand (grouping
sets), Python operators, and the columns read from ``events``. Streaming and
round-trip queries write files as a side effect; their plans are the read
side only and are listed without detail.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from visitflow.plans.catalog import QUERIES  # noqa: E402
from visitflow.session import local_session  # noqa: E402

SIDE_EFFECT = {"silver_partitioned_roundtrip", "gold_roundtrip"}


def summarise(plan: str) -> dict[str, object]:
    read = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    return {
        "scans": plan.count("FileScan parquet"),
        "hash shuffles": len(re.findall(r"Exchange hashpartitioning", plan)),
        "range shuffles": len(re.findall(r"Exchange rangepartitioning", plan)),
        "single shuffles": len(re.findall(r"Exchange SinglePartition", plan)),
        "partial aggs": len(re.findall(r"HashAggregate\(keys=\[[^\]]*\], functions=\[partial_", plan)),
        "partial window limits": len(re.findall(r"WindowGroupLimit .*Partial", plan)),
        "top-k": plan.count("TakeOrderedAndProject"),
        "expand": plan.count("Expand"),
        "python": sum(plan.count(op) for op in ("BatchEvalPython", "ArrowEvalPython", "InPandas")),
        "columns read": sorted({c.split(":")[0] for r in read for c in r.split(",") if c}),
    }


def main(argv: list[str]) -> None:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    out = argv[2] if len(argv) > 2 else None
    spark = local_session(8)
    lines = [
        "# Physical plans of the registered queries",
        "",
        f"Generated by `tools/plan_report.py` on `{sf_dir}` (AQE initial plans, before",
        "runtime re-planning). Shuffles are counted per plan node. The dedupe shuffle is",
        "the `hashpartitioning(id)` one; gold aggregates add one small hash shuffle each;",
        "range shuffles sort tiny aggregate results. Streaming queries run as files are",
        "replayed; see `streaming/silver.py` for their plans.",
        "",
        "| query | scans | hash | range | single | partial aggs | partial window limits | top-k | expand | python | columns read from events |",
        "| --- | --- | --- | --- | --- | --- | --- | --- | --- | --- | --- |",
    ]
    for name, fn in QUERIES.items():
        if name.startswith("stream_") or name in SIDE_EFFECT:
            continue
        if name == "gold_one_pass":
            # The query reads a checkpoint; report the aggregate that fills it.
            from visitflow.operators import gold, silver
            from visitflow.sources.fixture import read_bronze

            df = gold.aggregate_all(silver.clean(read_bronze(spark, sf_dir)))
            name = "gold_one_pass (checkpointed aggregate)"
        else:
            df = fn(spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = summarise(plan)
        cols = ", ".join(s.pop("columns read"))
        lines.append(f"| {name} | " + " | ".join(str(v) for v in s.values()) + f" | {cols} |")
    text = "\n".join(lines) + "\n"
    if out:
        with open(out, "w") as fh:
            fh.write(text)
    print(text)


if __name__ == "__main__":
    main(sys.argv)
