"""Every registered query against its SQL counterpart on the given tables."""

import os
import subprocess
import sys
from pathlib import Path

import pytest
from oracle import compare, connect

import __spark_entry__ as contract

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


def test_every_query_has_sql():
    """Optional queries without SQL are tested against brute force instead."""
    assert contract.queries().keys() - contract._llm_queries().keys() <= contract.oracle_sql().keys() <= contract.queries().keys()


@pytest.mark.parametrize("name", contract.oracle_sql())
def test_query_matches_sql(spark, connection, name):
    frame = contract.queries()[name](spark, FOLDER)
    assert compare(frame, connection, contract.oracle_sql()[name]) > 0


@pytest.mark.parametrize("missing", ["rollcall.llm", "corpus_pipeline", "public_tokenizers", "sentencepiece"])
def test_queries_without_what_is_optional(missing):
    """In a process of its own where a module cannot be imported."""
    code = f"""
import sys, warnings
warnings.simplefilter("ignore")
sys.modules[{missing!r}] = None
import __spark_entry__ as contract
names = contract.queries().keys()
assert "size_histogram" in names and names == contract.oracle_sql().keys() and not contract._llm_queries()
"""
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(contract.__file__).parent)


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.columns == ["bin", "category", "records"]
    assert frame.count() == 18
