"""The entry points without the corpus operators' folders."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent

PROBE = """
import __spark_entry__ as entry
from starloom.plans.queries import QUERIES
assert set(entry.queries()) == set(QUERIES) and set(entry.oracle_sql()) < set(QUERIES)
"""


def test_entry_without_corpus_folders(tmp_path):
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    shutil.copytree(ROOT / "starloom", tmp_path / "starloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    done = subprocess.run([sys.executable, "-c", PROBE], cwd=tmp_path, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    pipeline = ROOT / "corpus_pipeline.py"
    if pipeline.exists():  # the pipeline's file alone must not be imported either
        shutil.copy(pipeline, tmp_path)
        done = subprocess.run([sys.executable, "-c", PROBE], cwd=tmp_path, capture_output=True, text=True)
        assert done.returncode == 0, done.stderr
