from __future__ import annotations

import os
import subprocess
import sys

import pytest

import __spark_entry__ as entry
from check import compare

from retailgold.bind.queries import all_queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "check_id" in df.columns


def test_every_query_has_an_oracle():
    assert set(all_queries()) <= set(entry.queries()) and set(all_queries()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("gone", ["corpus_pipeline", "retailgold.llm", "regex"])
def test_training_data_queries_are_optional(gone):
    """Without their modules, or a library they need, all other queries are there."""
    code = f"gone = {gone!r}" + """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name == gone or name.startswith(gone + "."):
            raise ModuleNotFoundError(name, name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
from retailgold.bind.queries import all_queries
assert set(e.queries()) == set(all_queries()) == set(e.oracle_sql())
"""
    subprocess.run([sys.executable, "-c", code], check=True, cwd=os.path.dirname(entry.__file__))


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_equals_its_oracle(spark, name, capsys):
    assert compare(spark, SF, [name]) == 0, capsys.readouterr().out
