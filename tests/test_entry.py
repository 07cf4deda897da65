"""The entry module where parts of the training-data subpackage cannot be imported."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

from tidewatch.plans.registry import QUERIES

ROOT = Path(__file__).resolve().parents[1]
SCRIPT = """
import sys
class Hidden:
    def find_spec(self, name, path=None, target=None):
        if name == {name!r} or name.startswith({name!r} + "."):
            raise ModuleNotFoundError(name)
sys.meta_path.insert(0, Hidden())
import __spark_entry__ as entry
print(len(entry.queries()), len(entry.oracle_sql()), any(n.startswith("op") for n in entry.queries()))
"""


@pytest.mark.parametrize("name", ["zstandard", "tokenizers", "tidewatch.llm", "corpus_pipeline"])
def test_other_queries_remain(name):
    script = SCRIPT.format(name=name)
    done = subprocess.run([sys.executable, "-c", script], cwd=ROOT, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    queries, sql, _ = done.stdout.split()
    assert int(queries) >= len(QUERIES) and int(sql) >= len(QUERIES)
    if name == "tidewatch.llm":
        assert done.stdout.split() == [str(len(QUERIES)), str(len(QUERIES)), "False"]
