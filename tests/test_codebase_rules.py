"""Guards for the library's execution rules (source-level checks)."""

import pathlib
import re

ROOT = pathlib.Path(__file__).resolve().parents[1] / "ratesmith"


def _sources():
    return {p: p.read_text() for p in ROOT.rglob("*.py") if "llm" not in p.parts}


def test_no_local_checkpoint_or_python_udfs():
    for path, text in _sources().items():
        assert "localCheckpoint" not in text, path
        assert not re.search(r"\budf\(|pandas_udf|applyInPandas|mapInPandas", text), path


def test_no_collect_of_data_in_library():
    for path, text in _sources().items():
        assert ".collect()" not in text, path


def test_limit_only_in_preview():
    hits = [p.name for p, t in _sources().items() if ".limit(" in t]
    assert hits == ["readers.py"]
