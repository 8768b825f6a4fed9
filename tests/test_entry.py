"""The library stands without its optional subpackage."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def names(root):
    code = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert set(o) <= set(q); print(len(q), sum(n.startswith('op') for n in q), 'pipeline' in q)"
    return subprocess.run([sys.executable, "-B", "-c", code], cwd=root, capture_output=True, text=True, check=True, env=os.environ | {"PYTHONPATH": root}).stdout.split()


def test_without_the_subpackage(tmp_path):
    shutil.copytree(ROOT, tmp_path / "r", ignore=shutil.ignore_patterns("llm", ".git", "corpus_pipeline.py", "__pycache__"))
    count, ops, pipeline = names(str(tmp_path / "r"))
    assert int(count) > 60 and ops == "0" and pipeline == "False"


def test_nothing_else_imports_it():
    for folder, _, files in os.walk(os.path.join(ROOT, "headway")):
        for f in files:
            if f.endswith(".py") and os.sep + "llm" not in folder:
                assert "headway.llm" not in open(os.path.join(folder, f), encoding="utf-8").read(), f
