import random

import pytest


@pytest.fixture
def frame(spark):
    """A table of documents with extra columns whose names the operators use themselves."""

    def make(rows):
        """rows: (doc_id, text) or (doc_id, text, source)."""
        full = [(i, t, (r + (None,))[0] if r else "a", 1, 2, "x", "y") for i, t, *r in [(x[0], x[1], *x[2:]) for x in rows] for r in [tuple(r)]]
        return spark.createDataFrame(full, "doc_id long, text string, source string, dk int, rank int, f string, score string")

    return make


@pytest.fixture
def odd_rows():
    """Null ids and texts, empty and blank texts, repeated rows, ties, a long text, letters beyond the first plane."""
    draw = random.Random(3)
    words = [draw.choice(["to", "be", "or", "not", "é", "漢字", "x1", "end."]) for _ in range(4000)]
    return [(1, None), (2, ""), (3, " \n\t "), (None, "alone"), (None, None), (4, "twice the same"), (4, "twice the same"), (5, "twice the same"), (4, "other text"), (6, " ".join(words)), (7, "a \U0001f600 b\x00c"), (8, "word")]
