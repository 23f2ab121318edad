"""The catalogue without the optional text operators: a copy of the repository without their two folders."""

import os
import shutil
import subprocess
import sys

from tillwise.plans import catalog

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SAYS = "import __spark_entry__ as e; print('\\n'.join(sorted(e.queries()))); print('--'); print('\\n'.join(sorted(e.oracle_sql())))"


def _catalogue(tmp_path, *left_out):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache", "metastore_db", "spark-warehouse"))
    for name in left_out:
        gone = copy / name
        shutil.rmtree(gone) if gone.is_dir() else gone.unlink(missing_ok=True)
    out = subprocess.run([sys.executable, "-c", SAYS], cwd=copy, capture_output=True, text=True, timeout=120,
                         env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    assert out.returncode == 0, out.stderr
    names, oracles = out.stdout.split("--")
    return names.split(), oracles.split()


def test_without_the_two_folders(tmp_path):
    """The pipeline's file is still there, and cannot be imported."""
    names, oracles = _catalogue(tmp_path, "tillwise/llm", "tests/llm")
    assert names == sorted(catalog.QUERIES) and oracles == sorted(catalog.ORACLES)


def test_without_pipeline_and_folders(tmp_path):
    names, oracles = _catalogue(tmp_path, "tillwise/llm", "tests/llm", "corpus_pipeline.py")
    assert names == sorted(catalog.QUERIES) and oracles == sorted(catalog.ORACLES)
