"""The entry without the optional part."""

import subprocess
import sys
from pathlib import Path

import pytest

CODE = """
import sys
sys.modules[{missing!r}] = None
import __spark_entry__ as entry
queries, oracle = entry.queries(), entry.oracle_sql()
assert "silver" in queries and set(queries) == set(oracle), set(queries) ^ set(oracle)
"""


@pytest.mark.parametrize("missing", ["ledgerfall.llm", "corpus_pipeline", "ahocorasick", "tokenizers", "zstandard", "xxhash", "regex"])
def test_text_operators_may_be_missing(missing):
    root = Path(__file__).resolve().parents[1]
    subprocess.run([sys.executable, "-c", CODE.format(missing=missing)], cwd=root, check=True)
