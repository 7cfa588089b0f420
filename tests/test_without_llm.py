"""The rest of the library stands without the llm subpackage."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).parents[1]


def test_entry_imports_without_llm(tmp_path):
    for p in ("eventlake", "__spark_entry__.py"):
        (shutil.copytree if (ROOT / p).is_dir() else shutil.copy)(ROOT / p, tmp_path / p)
    shutil.rmtree(tmp_path / "eventlake" / "llm", ignore_errors=True)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'post_performance' in q and 'pipeline' not in q and set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)})


def test_nothing_else_imports_llm():
    for p in (ROOT / "eventlake").rglob("*.py"):
        if "llm" not in p.relative_to(ROOT).parts:
            assert "llm" not in p.read_text(), p
