"""The entry point without its optional part."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
BLOCK = """
import sys
class Missing:
    def find_spec(self, name, path=None, target=None):
        if name == {name!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Missing())
import __spark_entry__ as entry
names = set(entry.queries())
assert "flow_full" in names and not any(n.startswith("op") or n == "pipeline" for n in names)
assert set(entry.oracle_sql()) <= names
"""


@pytest.mark.parametrize("name", ["zstandard", "corpus_pipeline", "eventstats.llm"])
def test_core_queries_survive_a_missing_optional_module(name):
    code = BLOCK.format(name=name)
    run = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert run.returncode == 0, run.stderr
    assert "left out" in run.stderr
