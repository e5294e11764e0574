import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from linetally.llm.language import UNKNOWN, fit, posteriors, predicted, trained

VOICES = {"aa": ["banana", "lama", "kara", "tala"], "oo": ["gold", "wolk", "storm", "torf"], "üü": ["früh", "güte", "müde", "kühl"]}


def sentence(rng, lang, n):
    return " ".join(rng.choice(VOICES[lang]) + rng.choice(["", "n", "s"]) for _ in range(n))


def one_by_one(e, moves, start):
    n, k = e.shape
    a, b = np.zeros((n, k)), np.ones((n, k))
    for t in range(n):
        a[t] = (np.exp(start) if not t else a[t - 1] @ np.exp(moves)) * np.exp(e[t])
        a[t] /= a[t].sum()
    for t in range(n - 2, -1, -1):
        b[t] = np.exp(moves) @ (b[t + 1] * np.exp(e[t + 1]))
        b[t] /= b[t].sum()
    return a * b / (a * b).sum(1, keepdims=True)


@pytest.mark.parametrize("block", [3, 16, 128])
def test_forward_backward_is_exact(block):
    rng = np.random.default_rng(block)
    first = np.array([0, 0, 5, 300, 301, 700, 700])
    e, moves, start = rng.normal(size=(700, 3)) * 3, rng.normal(size=(3, 3)), rng.normal(size=3)
    p = posteriors(e, first, moves, start, block)
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b > a:
            assert np.allclose(p[a:b], one_by_one(e[a:b], moves, start))


@pytest.fixture(scope="module")
def model():
    rng = random.Random(1)
    langs = [x for x in VOICES for _ in range(30)]
    return fit([sentence(rng, x, 40) for x in langs], langs, rounds=60)


def test_code_switched_text(frame, model):
    rng = random.Random(2)
    rows = [(1, sentence(rng, "aa", 20) + " " + sentence(rng, "oo", 15)), (2, sentence(rng, "üü", 9))]
    got = {r["doc_id"]: r for r in predicted(frame(rows), model).collect()}
    assert [(s["lang"], s["first_word"], s["last_word"]) for s in got[1]["spans"]] == [("aa", 0, 19), ("oo", 20, 34)]
    assert got[1]["lang_pred"] == "aa" and got[2]["lang_pred"] == "üü" and got[2]["score"] > 0.9


def test_edges(frame, edge, model):
    rows = edge + [(50, "123 -- 4"), (51, "“…” —")]
    got = predicted(frame(rows), model).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    assert all((r["lang_pred"] == UNKNOWN) == (r["doc_id"] in (1, 2, 3, 50, 51) or (r["doc_id"] is None and r["n_words"] == 0)) for r in got)
    assert {r["lang_pred"] for r in predicted(frame(rows), None).collect()} == {UNKNOWN}
    assert predicted(frame([]), model).count() == 0


def test_learns_from_marked_rows_only(spark):
    rng = random.Random(3)
    rows = [(i, sentence(rng, x, 30), x) for i, x in enumerate(x for x in VOICES for _ in range(20))]
    rows += [(100 + i, sentence(rng, "aa", 30), "wrong") for i in range(20)] + [(200, "text", None), (201, None, "aa")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = trained(docs, F.col("doc_id") % 200 < 100)
    assert found.languages == sorted(VOICES)
    assert trained(docs.limit(0), F.lit(True)) is None


def test_many_rows_of_a_language_still_teach(spark):
    rows = spark.range(9_000_000).withColumnRenamed("id", "doc_id")
    a = F.col("doc_id") % 2 == 0
    docs = rows.select("doc_id", F.when(a, "banana lama kara tala").otherwise("gold wolk storm torf").alias("text"), F.when(a, "aa").otherwise("oo").alias("lang"))
    found = trained(docs, F.lit(True), most_rows=4)
    assert found is not None and found.languages == ["aa", "oo"]
