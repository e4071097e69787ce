"""The entry point with and without the optional training-text operators."""

from __future__ import annotations

import pathlib
import shutil
import subprocess
import sys

import pytest

REPO = pathlib.Path(__file__).resolve().parent.parent
ASK = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"


def counts(repo: pathlib.Path) -> tuple[int, int]:
    told = subprocess.run([sys.executable, "-c", ASK], cwd=repo, capture_output=True, text=True, check=True)
    queries, sql = told.stdout.split()
    return int(queries), int(sql)


@pytest.mark.parametrize("absent", [("llm",), ("corpus_pipeline.py",), ("llm", "corpus_pipeline.py")])
def test_entry_without_operators(tmp_path, absent):
    for name in ("__spark_entry__.py", "corpus_pipeline.py", "workload", "tidemark"):
        source = REPO / name
        if source.is_dir():
            shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("__pycache__", *absent))
        elif source.exists() and name not in absent:
            shutil.copy(source, tmp_path / name)
    queries, sql = counts(tmp_path)
    assert queries == sql >= 54
