"""Small tables with the odd rows that every operator must take."""

import pytest
from llm_samples import sentence


@pytest.fixture(scope="session")
def odd_docs(spark):
    """NULLs in any column, empty and long texts, ties, repeated rows, and columns whose names clash."""
    rows = [
        (1, sentence(1, 60), "a"),
        (2, sentence(1, 60), "a"),
        (2, sentence(1, 60), "a"),
        (3, None, "b"),
        (4, "", None),
        (5, "  \n\t ", "b"),
        (None, sentence(2, 30), "b"),
        (6, None, None),
        (7, "one", "c"),
        (8, sentence(3, 3000), "c"),
        (9, sentence(3, 1500) + " x " + sentence(4, 40), "d"),
        (10, sentence(5, 40), "d"),
        (10, sentence(6, 40), "d"),
    ]
    extra = [(*r, i, "x", 0.5, i) for i, r in enumerate(rows)]
    schema = "doc_id long, text string, source string, size int, target string, score double, component_id int"
    return spark.createDataFrame(extra, schema)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
