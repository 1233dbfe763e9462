"""The driver contract without the optional training-data subpackage."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

from conftest import ROOT

from visitflow.plans.catalog import QUERIES

SAYS = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"


def test_entry_without_the_subpackage(tmp_path):
    shutil.copytree(f"{ROOT}/visitflow", tmp_path / "visitflow", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    env = os.environ | {"PYTHONPATH": ""}
    said = subprocess.run([sys.executable, "-c", SAYS], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert said.returncode == 0, said.stderr
    names, oracles = said.stdout.strip().splitlines()
    assert names.split() == oracles.split() == sorted(QUERIES)
