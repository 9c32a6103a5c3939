"""The library without its corpus operators: the other queries must still be there."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
COUNT = "import __spark_entry__ as e; q = e.queries(); print(len(q), sum(n.startswith(('op', 'pipeline')) for n in q), set(e.oracle_sql()) <= set(q))"


@pytest.mark.parametrize("gone", [("tickloom/llm", "tests/llm"), ("tickloom/llm", "tests/llm", "corpus_pipeline.py")])
def test_queries_without_the_corpus_operators(tmp_path, gone):
    where = tmp_path / "copy"
    shutil.copytree(ROOT, where, ignore=shutil.ignore_patterns(".git", "__pycache__", *[os.path.basename(g) for g in gone]))
    env = {**os.environ, "PYTHONPATH": os.pathsep.join(p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if os.path.abspath(p or ".") != ROOT)}
    said = subprocess.run([sys.executable, "-c", COUNT], cwd=where, env=env, capture_output=True, text=True, timeout=300)
    assert said.returncode == 0, said.stderr
    n, corpus, whole = said.stdout.split()
    assert int(n) > 100 and int(corpus) == 0 and whole == "True"
