"""The entry module without the training-data subpackage."""

import os
import shutil
import subprocess
import sys

from stratus.plans.catalog import ORACLE, QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_core_stands_alone(tmp_dir):
    tree = os.path.join(tmp_dir, "tree")
    shutil.copytree(ROOT, tree, ignore=lambda folder, names: [
        n for n in names if n in (".git", "llm", "__pycache__", ".pytest_cache") or n.endswith(".json")])
    script = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"

    def run(*args):
        return subprocess.run([sys.executable, *args], cwd=tree, capture_output=True, text=True, check=True).stdout

    # The pipeline module may lie there without the subpackage, or be gone with it.
    for _ in range(2):
        assert run("-c", script).split()[-2:] == [str(len(QUERIES)), str(len(ORACLE))]
        shutil.rmtree(os.path.join(tree, "stratus", "llm"), ignore_errors=True)
        os.makedirs(os.path.join(tree, "stratus", "llm", "__pycache__"))
    collected = run("-m", "pytest", "--collect-only", "-q", "tests")
    assert "test_oracle.py" in collected
