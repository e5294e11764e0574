import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from linetally.llm.common import hash_63, last_drawn
from linetally.llm import quality
from linetally.llm.quality import DIMENSIONS, _drawn, estimate_prior, features, fit, scored, trained, with_score


def good(rng):
    return ". ".join(" ".join(rng.choice(["the", "wind", "over", "hills", "carries", "rain"]) + rng.choice(["", "s", "ed"]) for _ in range(rng.randint(5, 12))) for _ in range(6))


def poor(rng):
    return rng.choice([" ".join([rng.choice(["spam", "buy"])] * 60), " | ".join("CLICK!!" for _ in range(30)), "### $$$ " * 40])


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(1)
    rows = [(i, poor(rng) if i % 10 < 3 else good(rng)) for i in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(1200) if i % 10 >= 3 and i % 3 == 0] + [(5, None), (9999, 1)], "doc_id long, quality int")
    return docs, labels


def test_held_out_rows_are_told_apart(corpus):
    docs, labels = corpus
    model, prior = trained(docs, labels, F.col("doc_id") % 5 != 0)
    # of the unlabelled rows, 3 in 10 are poor and two thirds of the good ones are left
    assert 0.45 < prior < 0.75
    got = scored(docs.where("doc_id % 5 = 0"), model).collect()
    right = [(r["score"] >= 0.3) == (r["doc_id"] % 10 >= 3) for r in got]
    assert sum(right) / len(right) > 0.97


def test_prior():
    rng = np.random.default_rng(0)
    p, u = rng.normal(2, 1, (3000, 4)), np.concatenate([rng.normal(2, 1, (1200, 4)), rng.normal(-2, 1, (1800, 4))])
    assert abs(estimate_prior(p.astype(np.float32), rng.permutation(u).astype(np.float32)) - 0.4) < 0.08


def test_nothing_to_learn_from(corpus, frame, edge):
    docs, labels = corpus
    model, prior = trained(docs, labels.limit(0), F.lit(True))
    assert model is None and prior == 0.5
    assert {r["score"] for r in scored(frame(edge), model).collect()} == {0.5}


def test_edges(frame, edge):
    x = features(pa.array([t for _, t in edge]))
    assert x.shape == (len(edge), DIMENSIONS) and np.isfinite(x).all()
    one_by_one = np.concatenate([features(pa.array([t], pa.string())) for _, t in edge])
    assert np.allclose(x, one_by_one, atol=1e-5)
    model, _ = fit(x[:8], x[8:], 0.5)
    docs = frame(edge)
    got = with_score(docs, model, "score_2")
    assert got.columns == [*docs.columns, "score_2"] and len(docs.columns) == 10
    assert all(0 <= r["score_2"] <= 1 for r in got.collect())
    assert scored(frame([]), model).count() == 0


def test_many_rows_still_give_a_sample(spark):
    n = _drawn(spark.range(9_000_000).withColumnRenamed("id", "doc_id"), 8).count()
    assert 1 <= n <= 24
    assert _drawn(spark.range(500).withColumnRenamed("id", "doc_id"), 500).count() == 500
    assert last_drawn(5, 5) == last_drawn(5, 0) == (1 << 63) - 1 and last_drawn(4_000, 10**13) > 10**9
    assert spark.range(1000).agg(F.min(hash_63("id"))).first()[0] >= 0


def test_training_goes_down_the_risk():
    """Steps go down the non-negative risk, written out here row by row."""
    rng = np.random.default_rng(1)
    pos, unl, prior = rng.normal(1, 1, (20, 6)), rng.normal(0, 1, (30, 6)), 0.4

    def risk(model):
        loss = lambda z: np.log1p(np.exp(-z))
        zp, zu = model.raw(pos), model.raw(unl)
        part = sum(loss(-z) for z in zu) / len(zu) - prior * sum(loss(-z) for z in zp) / len(zp)
        return prior * sum(loss(z) for z in zp) / len(zp) + max(0.0, part)

    quality_steps = quality.LEAST_STEPS
    try:
        risks = []
        for steps in (1, 10, 40, 80):
            quality.LEAST_STEPS = steps
            risks.append(risk(quality._fit(pos.astype(np.float32), unl.astype(np.float32), prior, 0, 5)))
    finally:
        quality.LEAST_STEPS = quality_steps
    assert risks == sorted(risks, reverse=True) and risks[-1] < risks[0] / 2


def test_average_of_networks():
    rng = np.random.default_rng(2)
    pos, unl = rng.normal(1, 1, (40, 5)).astype(np.float32), rng.normal(0, 1, (60, 5)).astype(np.float32)
    models = [quality._fit(pos, unl, 0.3, 2, seed) for seed in range(3)]
    mean = sum(m.raw(unl) for m in models) / 3
    assert np.allclose(quality._averaged(models).raw(unl), mean, atol=1e-4)
