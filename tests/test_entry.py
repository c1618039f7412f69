"""The contract still works when the text operators and the pipeline are taken out."""

import pathlib
import shutil
import subprocess
import sys

ROOT = pathlib.Path(__file__).resolve().parent.parent


def test_entry_without_text_operators(tmp_path):
    shutil.copytree(ROOT / "ebbline", tmp_path / "ebbline", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; print(len(e.queries()), [n for n in e.queries() if n[:2] == 'op' or n == 'pipeline'], set(e.oracle_sql()) <= set(e.queries()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={"PYTHONPATH": str(tmp_path), "PATH": "/usr/bin:/bin"}, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    count, rest = done.stdout.split(" ", 1)
    assert int(count) > 60 and rest.strip() == "[] True"


def test_nothing_else_imports_the_text_operators():
    for path in [*(ROOT / "ebbline").rglob("*.py"), ROOT / "bench.py"]:
        if "llm" not in path.relative_to(ROOT).parts:
            assert "ebbline.llm" not in path.read_text()
