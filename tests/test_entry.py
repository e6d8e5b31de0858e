"""The driver's contract, with and without the corpus subpackage."""

import os
import subprocess
import sys

import __spark_entry__ as entry
from tests.conftest import ROOT

BLOCK = """
import sys
class Block:
    def find_spec(self, name, path=None, target=None):
        if name == "corpus_pipeline" or name.startswith("deliverylens.llm"):
            raise ImportError(name)
sys.meta_path.insert(0, Block())
import __spark_entry__ as e
assert not [q for q in e.queries() if q.startswith("op")] and "pipeline" not in e.queries()
assert len(e.queries()) > 100 and set(e.oracle_sql()) <= set(e.queries())
print("fine")
"""


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "error_rate" in df.columns


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_rest_works_without_the_corpus_subpackage():
    done = subprocess.run([sys.executable, "-B", "-c", BLOCK], cwd=ROOT, env=os.environ | {"PYTHONPATH": ROOT}, capture_output=True, text=True)
    assert done.stdout.strip().endswith("fine"), done.stderr
