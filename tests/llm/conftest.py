import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")

SF = "/root/testdata/sf0.001"

#: Null and empty texts, ties, repeated rows, a very long text, non-ASCII, and an extra column with a clashing name.
EDGE = [
    (1, None, "x"), (2, "", "x"), (3, "one two", None), (4, "one two", "x"), (4, "one two", "x"),
    (5, "a " * 30_000, "y"), (6, "é ü 日本 🙂 naïve café " * 8, "y"), (7, "\n\t  ", "y"), (None, "no id here at all, none", "z"),
    (8, "z" * 70_000, "z"),
]
SCHEMA = "doc_id long, text string, node string"


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(EDGE, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
