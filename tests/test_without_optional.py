"""The library imports and its queries stay registered in copies that lack the optional subpackage, the pipeline or both."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("pipeline", [True, False])
def test_copy_without_the_subpackage(tmp_path, pipeline):
    ignore = shutil.ignore_patterns("llm", "__pycache__")
    for folder in ("subspan", "parity"):
        shutil.copytree(ROOT / folder, tmp_path / folder, ignore=ignore)
    for name in ["__spark_entry__.py", *["corpus_pipeline.py"] * pipeline]:
        if (ROOT / name).exists():
            shutil.copy(ROOT / name, tmp_path)
    code = "import __spark_entry__ as e; names = e.queries(); assert set(e.oracle_sql()) <= set(names); print(len(names), e.FLAGSHIP in names)"
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={"PYTHONPATH": str(tmp_path), "PATH": "/usr/bin:/bin"}, capture_output=True, text=True)
    assert run.returncode == 0, run.stderr
    count, flagship = run.stdout.split()
    assert int(count) >= 124 and flagship == "True"
