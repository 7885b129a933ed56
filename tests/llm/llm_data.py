"""Rows that every operator must take."""

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, cell int, side int, token long, component long"
LONG = "ein sehr langer Text ohne Ende und Sinn " * 4000 + "x" * 30_000


def texts():
    base = " ".join(f"word{i}" for i in range(60))
    return [(1, base), (2, base), (3, base + " tail"), (4, "Other " + base.replace("word30", "changed")), (5, None), (6, ""), (7, " \t\n "),
            (8, "One two"), (9, "one TWO"), (10, "a b c d e"), (11, LONG), (12, LONG + " more"), (13, "12 34 !! 5"), (None, base), (None, None),
            (8, "One two"), (14, "é è ñ ß ü"), (15, "the cat and the dog were in the garden")]


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls, empty and long texts, ties, repeated rows, and extra columns with clashing names."""
    return spark.createDataFrame([(i, t, "en", None, 0, 0.5, 1, 1, 1, 1) for i, t in texts()], DOCS)


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
