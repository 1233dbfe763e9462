"""bench.py prints exactly one JSON line with the fields the driver records."""

from __future__ import annotations

import json
import os
import subprocess
import sys

from conftest import ROOT, SMALL


def test_bench_prints_one_json_line():
    env = dict(
        os.environ,
        BENCH_SF_DIR=SMALL,
        BENCH_CPUS="2",
        BENCH_REPEAT="1",
        BENCH_QUERIES="silver_row_count,gold_one_pass",
    )
    proc = subprocess.run(
        [sys.executable, os.path.join(ROOT, "bench.py")],
        env=env,
        capture_output=True,
        text=True,
        timeout=600,
        check=True,
    )
    lines = [line for line in proc.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    out = json.loads(lines[0])
    assert out["unit"] == "sec" and out["sf"] == 0.001
    assert set(out["queries"]) == {"silver_row_count", "gold_one_pass"}
    assert out["value"] > 0 and all(v > 0 for v in out["queries"].values())
