"""The registry works with the training-data part and without it."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__
from gridlake.plans import queries

ROOT = Path(__file__).resolve().parents[1]
PRINT = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); print(len(q), len(o), sum(n.startswith('op') or n == 'pipeline' for n in [*q, *o]))"


@pytest.mark.parametrize("removed", [("gridlake/llm", "tests/llm"), ("gridlake/llm", "tests/llm", "corpus_pipeline.py"), ("corpus_pipeline.py",)])
def test_parts_can_be_removed(tmp_path, removed):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "*.json", "spark-warehouse"))
    for name in removed:
        (shutil.rmtree if (copy / name).is_dir() else Path.unlink)(copy / name) if (copy / name).exists() else None
    done = subprocess.run([sys.executable, "-c", PRINT], cwd=copy, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    n, oracles, training = map(int, done.stdout.split())
    if "gridlake/llm" in removed:
        assert (n, oracles, training) == (len(queries.queries()), len(queries.oracle_sql()), 0)
    else:
        assert n >= len(queries.queries())


def test_every_oracle_has_a_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
