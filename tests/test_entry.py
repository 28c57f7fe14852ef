"""The driver contract without the training-data operators."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SHOW = "import __spark_entry__ as e; print(*sorted(e.queries())); assert set(e.oracle_sql()) <= set(e.queries())"


@pytest.mark.parametrize("pipeline", [False, True])
def test_entry_without_the_subpackage(tmp_path, pipeline):
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    shutil.copytree(f"{ROOT}/tallyframe", tmp_path / "tallyframe", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    if pipeline and os.path.exists(f"{ROOT}/corpus_pipeline.py"):
        shutil.copy(f"{ROOT}/corpus_pipeline.py", tmp_path)
    run = subprocess.run([sys.executable, "-c", SHOW], cwd=tmp_path, capture_output=True, text=True,
                         env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    assert run.returncode == 0, run.stderr
    names = run.stdout.split()
    assert "nb_accuracy" in names and "pipeline" not in names and not any(n.startswith("op") and n[2].isdigit() for n in names)
