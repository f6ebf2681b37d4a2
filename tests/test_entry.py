"""The entry point works without the corpus subpackage."""

import os
import subprocess
import sys

ROOT = os.path.abspath(os.path.join(os.path.dirname(__file__), ".."))

#: Imports as if the subpackage and the pipeline were not there.
HIDDEN = """
import importlib.abc, sys
class Hide(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path=None, target=None):
        if name == "seispark.llm" or name.startswith("seispark.llm.") or name == "corpus_pipeline":
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
sys.meta_path.insert(0, Hide())
import __spark_entry__ as e
assert "iteration_job" in e.queries() and "iteration_job" in e.oracle_sql()
assert not any(n.startswith("op") and n[2:3].isdigit() or n == "pipeline" for n in e.queries())
"""


def test_without_the_subpackage():
    subprocess.run([sys.executable, "-c", HIDDEN], cwd=ROOT, check=True)


def test_oracles_belong_to_queries():
    sys.path.insert(0, ROOT)
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
