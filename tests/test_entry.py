"""Registration does not depend on the text operators, nor on the packages that they alone need."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
COUNT = "import __spark_entry__ as e; from veilspark.plans.catalog import QUERIES; assert set(e.queries()) {op} set(QUERIES), len(e.queries())"


@pytest.mark.parametrize("module", ["ahocorasick", "tokenizers", "public_tokenizers", "veilspark.llm"])
def test_base_queries_without_the_text_operators(module):
    code = f"import sys; sys.modules[{module!r}] = None; " + COUNT.format(op="==")
    done = subprocess.run([sys.executable, "-W", "ignore", "-c", code], cwd=ROOT, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-500:]
