"""The entry file imports whichever of the optional parts are there."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("gone", [("loomdex/llm",), ("loomdex/llm", "corpus_pipeline.py"), ("corpus_pipeline.py",)])
def test_entry_without_optional_parts(tmp_path, gone):
    absent = {str(ROOT / g) for g in gone}

    def left_out(folder, names):
        return [n for n in names if os.path.join(folder, n) in absent or n == "__pycache__"]

    shutil.copytree(ROOT / "loomdex", tmp_path / "loomdex", ignore=left_out)
    for name in {"__spark_entry__.py", "corpus_pipeline.py"} - set(gone):
        if (ROOT / name).exists():
            shutil.copy(ROOT / name, tmp_path)
    code = "import __spark_entry__ as e; print(*e.queries(), *e.oracle_sql())"
    env = os.environ | {"PYTHONPATH": str(tmp_path)}
    names = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, check=True).stdout.split()
    assert "hybrid_search" in names and "pipeline" not in names
    assert "loomdex/llm" not in gone or not any(n.startswith("op") for n in names)
