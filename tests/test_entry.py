"""The driver's contract without the training-data operators."""

import os
import subprocess
import sys

import pytest

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("missing", ["tickloom.llm", "corpus_pipeline", "ahocorasick"])
def test_core_queries_stay_if_a_module_is_missing(missing):
    program = f"""
import sys
sys.modules[{missing!r}] = None  # an import of it fails
import __spark_entry__ as e
assert not e.HAS_LLM and "pipeline" not in e.queries() and not [x for x in e.queries() if x.startswith("op")]
assert set(e.oracle_sql()) <= set(e.queries()) and "feature_table" in e.queries()
"""
    subprocess.run([sys.executable, "-c", program], cwd=HERE, check=True)
