import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from llm_helpers import DOCS  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from eventmill.session import get_spark
    s = get_spark("local[4]", app="llm-tests", conf={"spark.sql.shuffle.partitions": "4"})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def docs(spark):
    """Documents with every odd case: nulls in each column, empty and long texts, repeated rows, clashing columns."""
    words = ("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon " * 3).strip()
    rows = [
        (1, words, "en", "a", 1), (2, words, "en", "a", 1), (2, words, "en", "a", 1), (3, words.replace("gamma", "GAMMA"), "en", "b", 1),
        (4, "", "en", "b", 0), (5, None, None, None, None), (None, words + " end", "en", None, 1), (None, None, "en", "b", None),
        (6, "x", "en", "c", 1), (7, " ".join(f"w{i % 977}q{i}" for i in range(30000)), "de", "c", 9), (8, "one two", "fr", "a", 7),
    ]
    return spark.createDataFrame(rows, DOCS).selectExpr("*", "1 AS fingerprint", "2 AS score", "3 AS edits", "4 AS root", "5 AS size", "6 AS h")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)
