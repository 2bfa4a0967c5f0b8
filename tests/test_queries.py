"""Every registered query of the library has SQL and equals it on small tables."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest

import __spark_entry__ as contract
import check_queries
import oracle_queries

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
OWN = sorted(oracle_queries.oracle_sql())


def test_every_query_has_sql():
    others = {n for n in contract.queries() if n == "pipeline" or n.startswith("op")}
    assert set(contract.queries()) - others == set(OWN)


def test_entry(spark):
    assert contract.entry(spark).count() == 300


@pytest.mark.parametrize("name", OWN)
def test_query_equals_sql(spark, sf_dir, name):
    ours = contract.queries()[name](spark, sf_dir).toPandas()
    theirs = check_queries.expected(sf_dir, contract.oracle_sql()[name])
    assert check_queries.difference(ours, theirs) is None


@pytest.mark.parametrize("hidden", ["seatlens.llm", "regex", "public_tokenizers", "tokenizers"])
def test_entry_goes_without_what_only_the_training_text_needs(hidden):
    """A package that is missing takes its own queries along, no others."""
    code = (
        "import sys, importlib.abc\n"
        "class Hide(importlib.abc.MetaPathFinder):\n"
        "    def find_spec(self, name, path, target=None):\n"
        f"        if name == {hidden!r} or name.startswith({hidden + '.'!r}):\n"
        "            raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Hide())\n"
        "import __spark_entry__ as e\n"
        "print(len([n for n in e.queries() if n != 'pipeline' and not n.startswith('op')]))\n"
    )
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=ROOT, timeout=100)
    assert out.returncode == 0, out.stderr
    assert int(out.stdout) == len(OWN)
