"""The entry module works without a session, and without the optional parts."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = "import __spark_entry__ as e; q = e.queries(); assert set(e.oracle_sql()) <= set(q); print(len(q), any(k.startswith('op') for k in q))"


def _run(folder):
    return subprocess.run([sys.executable, "-c", CODE], cwd=folder, capture_output=True, text=True, timeout=120, check=True).stdout.split()


def test_import_without_a_session():
    assert int(_run(ROOT)[0]) > 200


def test_import_without_the_corpus_operators(tmp_path):
    shutil.copytree(os.path.join(ROOT, "tidemark"), tmp_path / "tidemark", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    n, corpus = _run(tmp_path)
    assert int(n) > 200 and corpus == "False"
