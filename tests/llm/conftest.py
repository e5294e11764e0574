import random

import pytest

EXTRA = "doc_id long, text string, hash long, key string, id string, part int, n int, __hash string, score double, found string"


@pytest.fixture
def frame(spark):
    """Documents from (doc_id, text) pairs, with further columns under names that operators use inside."""

    def make(rows):
        return spark.createDataFrame([(i, t, 1, "k", "x", 7, 3, "h", 0.5, "f") for i, t in rows], EXTRA)

    return make


@pytest.fixture
def edge():
    """Nulls, empty and blank texts, repeated rows and ids, ties, a long text and text beyond ASCII."""
    rng = random.Random(4)
    words = [f"word{i}" for i in range(300)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    one, two = text(60), text(80)
    rows = [(None, None), (None, one), (1, None), (2, ""), (3, " \n\t "), (4, one), (5, one), (5, one), (6, two), (7, two + " more"), (7, text(30))]
    return rows + [(8, text(60_000)), (9, "é ü 漢字 \u0000 \U0001f600 " * 20), (10, "a"), (11, "x" * 5000), (12, "Mixed CASE, don't stop. " * 30)]
