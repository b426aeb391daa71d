import os
import sys

import pytest
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def spark():
    from ratesmith.llm.queries import ready
    from ratesmith.session import local_session
    s = local_session("*", shuffle_partitions=4, app="ratesmith-llm-tests")
    ready(s)
    yield s
    s.stop()


LONG = "word other " * 20000


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and long texts, repeated rows, ties."""
    rows = [
        (1, "one two three four five six seven", "en", "a", 33),
        (2, "one two three four five six seven", "en", "a", 33),
        (2, "one two three four five six seven", "en", "a", 33),
        (3, None, "en", "b", None), (4, "", None, "b", 0), (5, " \n\t ", "en", None, 4),
        (6, LONG, "en", "b", len(LONG)), (None, "no id at all", "en", "a", 12),
        (None, "no id at all", "en", "a", 12), (7, "é😀 ü ñ\nline\nline", "de", "c", None),
        (8, "mail me at a.b@mail.example.com or +1 (234) 555-1234", "en", "c", 51),
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def clashing(odd):
    """The same rows with extra columns named like the operators' own."""
    names = ("score", "fp", "ids", "k", "dup", "size", "target", "taken", "h", "n", "lines", "key",
             "component_id", "predicted", "email", "hex", "next", "own", "copies", "notices", "chunk",
             "_text", "low", "rep", "v", "decoded", "at", "row", "begin", "d")
    return odd.withColumns({c: F.lit("x") for c in names})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(df):
    """Rows in a comparable order."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
