"""The driver's entry with and without the optional part."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("blocked", ["public_tokenizers", "regex", "ahocorasick", "xxhash", "corpus_pipeline", "revlens.llm"])
def test_library_queries_are_there_whatever_the_optional_part_lacks(blocked):
    code = f"import sys; sys.modules[{blocked!r}] = None; import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=100)
    queries, oracle = map(int, done.stdout.split())
    assert 50 <= oracle <= queries
