"""The driver contract without the optional corpus part."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def run(code):
    return subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True)


@pytest.mark.parametrize("missing", ["corpus_pipeline", "ratesmith.llm"])
def test_other_queries_stay_without_the_corpus_part(missing):
    done = run(f"""
import sys
sys.modules[{missing!r}] = None
import __spark_entry__ as e
assert "item_predictions" in e.queries() and "pipeline" not in e.queries()
assert not [q for q in e.queries() if q.startswith("op")]
assert set(e.oracle_sql()) <= set(e.queries())
""")
    assert done.returncode == 0, done.stderr[-500:]


def test_a_missing_package_leaves_the_other_queries():
    done = run("""
import os, sys, warnings
sys.modules["xxhash"] = None
with warnings.catch_warnings(record=True) as seen:
    warnings.simplefilter("always")
    import __spark_entry__ as e
assert "item_predictions" in e.queries() and "pipeline" not in e.queries()
assert not [q for q in e.queries() if q.startswith("op")]
told = [w for w in seen if "corpus queries are not registered" in str(w.message)]
assert bool(told) == os.path.isdir("ratesmith/llm")
""")
    assert done.returncode == 0, done.stderr[-500:]
