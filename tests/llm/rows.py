"""Fixtures of the text operators: small documents with every awkward case."""

import os

import pytest

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")

AWKWARD = [
    (1, None, "en", "a", None),
    (2, "", "en", None, 0),
    (3, " \n\t ", None, "a", 4),
    (4, "word", "en", "b", 4),
    (5, "Ünïcode wörds   and\u0085more", "de", "", 9),
    (6, "same text twice over " * 30, "en", "b", 600),
    (6, "same text twice over " * 30, "en", "b", 600),
    (7, "x" * 200_000, "en", "c", 200_000),
    (8, "a b c d e f g h " * 5000, "en", "c", 80_000),
    (None, "no id here", "en", None, 10),
    (None, None, None, None, None),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def awkward(spark):
    return spark.createDataFrame(AWKWARD, SCHEMA)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
