import os

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    if not os.path.isdir(SF):
        pytest.skip("the driver's tables are not here")
    return SF


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and very long texts, repeated rows and ids, and columns whose names clash with inner ones."""
    long = " ".join(f"word{i % 977}x{i}" for i in range(60_000))
    passage = " ".join(f"shared{i}" for i in range(40))
    rows = [(1, "alpha beta gamma delta " * 30, "a", 1.0), (2, None, None, None), (3, "", "b", 2.0), (4, long, "c", 3.0),
            (5, long, "c", 3.0), (5, long, "c", 3.0), (6, passage + " then one end", "d", 0.0),
            (7, "a start and " + passage, "d", 0.0), (7, "another text for the same id", "d", 0.0),
            (None, "no id " + passage, "e", 0.0), (None, None, None, None), (8, " \t\n ", "f", 0.0),
            (9, "é ü ñ " * 50 + "漢字 text", "g", 0.0)]
    return spark.createDataFrame(rows, "doc_id long, text string, t string, fp double").selectExpr(
        "doc_id", "text", "t", "fp", "'x' AS c0", "1 AS th", "2 AS okey", "3 AS id", "4 AS block", "5 AS rid", "'y' AS words",
        "6 AS __id", "7 AS component_id", "length(text) AS n_chars")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
