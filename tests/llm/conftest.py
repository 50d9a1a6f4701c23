import random

import pytest


@pytest.fixture(scope="session")
def table(spark):
    """Rows (doc_id, text) as documents, with columns whose names the operators use themselves."""

    def build(*rows):
        frame = spark.createDataFrame(list(rows), "doc_id long, text string")
        return frame.selectExpr("doc_id", "text", "1 AS k", "2 AS v", "'x' AS spans", "3 AS n")

    return build


@pytest.fixture
def chance():
    return random.Random(7)


# Nulls, empty and blank texts, repeated rows, a null id, a very long text.
ODD = [
    (901, None),
    (902, ""),
    (903, " \n\t "),
    (904, "same text here"),
    (904, "same text here"),
    (905, "same text here"),
    (None, "same  text here"),
    (906, "word " * 30_000),
    (907, "x" * 50_000),
]
