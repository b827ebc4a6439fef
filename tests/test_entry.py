"""The entry with and without the corpus operators."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import json, sys
import __spark_entry__ as entry
from scanledger.session import local_session
from workload.queries import ORACLES, QUERIES
assert set(entry.queries()) == set(QUERIES) and set(entry.oracle_sql()) == set(ORACLES)
rows = entry.queries()["inline_table"](local_session(2), "/root/testdata/sf0.001").count()
print("rows", rows)
"""


@pytest.mark.parametrize("without_pipeline", [False, True])
def test_entry_without_corpus_operators(tmp_path, without_pipeline):
    """A delivery without ``llm`` imports and runs, whether or not the pipeline's file is there."""

    def left_out(folder, names):
        gone = {"llm", ".git", "__pycache__", ".pytest_cache"}
        return [n for n in names if n in gone or (without_pipeline and n == "corpus_pipeline.py")]

    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=left_out)
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT], cwd=copy, capture_output=True, text=True, timeout=300, check=False
    )
    assert done.returncode == 0, done.stderr[-3000:]
    assert int(done.stdout.split()[-1]) > 0
