"""The entry offers the event engine's queries whatever the other package needs."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("missing", ["public_tokenizers", "corpus_pipeline", "eventlake.llm"])
def test_entry_without(missing):
    code = f"""
import sys
sys.modules[{missing!r}] = None  # importing it raises ImportError
import __spark_entry__ as e
from eventlake.plans import catalog
assert set(e.queries()) == set(catalog.QUERIES) and set(e.oracle_sql()) == set(catalog.ORACLES)
"""
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)
