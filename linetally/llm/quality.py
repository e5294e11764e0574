"""Quality classifier by positive-unlabelled learning.

Trusted positives and unlabelled web text are enough: no negative is shown to the model. With the class prior pi, the
risk of positives counted as negative is subtracted from that of unlabelled text counted as negative, and where the
difference would fall under zero (over-fitting) the step goes the other way: the non-negative unbiased risk

    pi * R_p(+) + max(0, R_u(-) - pi * R_p(-)).

The prior is estimated from the data. A first model tells positives from unlabelled text; above any score, the share of
unlabelled text cannot be less than pi times the share of positives, and the smallest such ratio, with a margin for
chance and on rows the first model has not seen, is the estimate. The loss is logistic; the trusted positives say where on
its scale texts stop being like them.

Inputs are the text's bytes alone: a histogram of trigrams of byte classes, and shares of repeated words and lines,
capitals, digits, marks and the like. Training takes at most ``most_positive`` and ``most_unlabelled`` rows, drawn by a
hash of the id; the driver sees their features (under 1,000 numbers a row) and nothing else.

Null text counts as empty; empty texts get the score of a text without a feature. Labels that repeat or disagree count
each; a null label is none. Where no positive or no unlabelled row can be learned from, every score is the prior 0.5.
Rows that repeat get the same score. An empty table gives an empty result. Other columns are never looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from linetally.llm.common import hash_63, last_drawn, ship, slices, utf8
from linetally.llm.words import Words, mixed, word_bytes

MOST_POSITIVE = 6_000
MOST_UNLABELLED = 14_000
#: Training steps of 512 rows at least, also on few rows.
LEAST_STEPS = 100
#: Weights decay by this over the number of rows: what a prior of one strength comes to at any size.
DECAY = 1.0
#: Networks whose outputs are averaged, each from weights and an order of its own; folds of the estimate of the prior.
NETWORKS, FOLDS = 5, 5
#: The score at and above which a text counts as good, and where it lies below the trusted positives.
CUT, REACH = 0.3, 3.0
STEP = 2 << 20
#: Byte classes: lower, upper, digit, space, line end, full stop and comma, other marks, beyond ASCII.
CLASSES = 8
_CLASS = np.full(256, 6, np.uint16)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[32], _CLASS[9:14], _CLASS[128:] = 0, 1, 2, 3, 4, 7
_CLASS[[44, 46]] = 5
_PLAIN = 12
DIMENSIONS = CLASSES**3 + _PLAIN


def _shares(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Mean of ``values`` between neighbouring offsets; 0 where there are none."""
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return (total[at[1:]] - total[at[:-1]]) / np.maximum(np.diff(at), 1)


def _distinct(keys: np.ndarray, doc: np.ndarray, docs: int) -> np.ndarray:
    """Number of different keys in each document."""
    if not len(keys):
        return np.zeros(docs)
    both = np.unique(mixed(keys + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)[1]
    return np.bincount(doc[both], minlength=docs).astype(np.float64)


def features(column: pa.Array) -> np.ndarray:
    """A row of numbers for each text."""
    raw, at = utf8(column)
    n = len(at) - 1
    out = np.zeros((n, DIMENSIONS), np.float32)
    if not len(raw):
        return out
    grams = CLASSES**3
    hist = np.zeros(n * grams, np.float64)
    owner = np.repeat(np.arange(n), np.diff(at))
    for a in range(0, len(raw), 1 << 22):  # by parts, for very long texts
        c = _CLASS[raw[a : a + (1 << 22) + 2]].astype(np.int64)
        if len(c) < 3:
            continue
        own = owner[a : a + len(c)]
        same = own[:-2] == own[2:]
        codes = (own[:-2] * grams + c[:-2] * CLASSES**2 + c[1:-1] * CLASSES + c[2:])[same]
        low = int(own[0]) * grams
        part = np.bincount(codes - low)
        hist[low : low + len(part)] += part
    hist = hist.reshape(n, grams)
    out[:, :grams] = np.sqrt(hist / np.maximum(hist.sum(1, keepdims=True), 1))

    words = Words.of(column, word_bytes("solid"))
    h, doc, count = words.hashes(), words.doc, np.diff(words.first).astype(np.float64)
    safe = np.maximum(count, 1)
    again = np.zeros(len(h), bool)
    again[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    pairs = h.copy()
    pairs[1:] = mixed(h[:-1]) + h[1:]
    mark = (_CLASS == 6) | (_CLASS == 5)
    marked = mark[words.data[words.end - 1]] & mark[words.data[np.maximum(words.end - 2, words.begin)]] & (words.end - words.begin > 1)
    lines = words.lines()
    heads = np.flatnonzero(np.diff(lines, prepend=-1)) if len(lines) else np.zeros(0, np.int64)
    line_hash = np.add.reduceat(mixed(h + np.arange(len(h), dtype=np.uint64) - np.repeat(heads, np.diff([*heads, len(h)])).astype(np.uint64)), heads) if len(heads) else h
    line_doc = doc[heads]
    n_lines = np.maximum(np.bincount(line_doc, minlength=n), 1)
    letters = (_CLASS[raw] == 0) | (_CLASS[raw] == 1)
    plain = [
        np.log1p(count) / 10,
        _shares(words.end - words.begin, words.first) / 20,
        _distinct(h, doc, n) / safe,
        _shares(again, words.first),
        _shares(_CLASS[raw] == 1, at) / np.maximum(_shares(letters, at), 1e-9),
        _shares(mark[raw], at),
        _shares(_CLASS[raw] == 2, at),
        np.where(count > 0, 1 - _distinct(line_hash, line_doc, n) / n_lines, 0),
        _shares(marked, words.first),
        _shares(raw == 124, at),
        _distinct(pairs, doc, n) / safe,
        np.log1p(count / n_lines) / 10,
    ]
    out[:, grams:] = np.stack(plain, 1)
    return out


def _loss(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, -z)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * z))


@dataclass
class Model:
    """One hidden layer over standardised features."""

    mean: np.ndarray
    scale: np.ndarray
    layers: list[np.ndarray]

    def raw(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.tanh((x - self.mean) / self.scale @ w1 + b1) @ w2 + b2[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.raw(x).astype(np.float64))


def _fit(pos: np.ndarray, unl: np.ndarray, prior: float | None, epochs: int, seed: int, hidden: int = 16) -> Model:
    """``prior`` None: tell positives from unlabelled rows; else the non-negative risk under this prior."""
    rng = np.random.default_rng(seed)
    n = len(pos) + len(unl)
    mean = (pos.sum(0, dtype=np.float64) + unl.sum(0, dtype=np.float64)) / n
    square = (np.einsum("ij,ij->j", pos, pos, dtype=np.float64) + np.einsum("ij,ij->j", unl, unl, dtype=np.float64)) / n
    model = Model(mean.astype(np.float32), (np.sqrt(np.maximum(square - mean**2, 0)) + 0.01).astype(np.float32), [])
    pos, unl = (pos - model.mean) / model.scale, (unl - model.mean) / model.scale
    d = pos.shape[1]
    model.layers = [rng.normal(0, 1 / np.sqrt(d), (d, hidden)).astype(np.float32), np.zeros(hidden, np.float32), rng.normal(0, 0.3, hidden).astype(np.float32), np.zeros(1, np.float32)]
    state = [(np.zeros_like(p), np.zeros_like(p)) for p in model.layers]
    decay = 1e-4 + DECAY / n
    steps, size, t = max(1, len(unl) // 512), min(512, len(unl)), 0
    for _ in range(max(epochs, -(-LEAST_STEPS // steps))):
        order_u, order_p = rng.permutation(len(unl)), rng.integers(0, len(pos), (steps, min(256, len(pos))))
        for s in range(steps):
            xp, xu = pos[order_p[s]], unl[order_u[s * size : (s + 1) * size]]
            x = np.concatenate([xp, xu])
            w1, b1, w2, b2 = model.layers
            hid = np.tanh(x @ w1 + b1)
            z = hid @ w2 + b2[0]
            zp, zu = z[: len(xp)], z[len(xp) :]
            gp_pos, gp_neg, gu_neg = -_sigmoid(-zp) / len(xp), _sigmoid(zp) / len(xp), _sigmoid(zu) / len(xu)
            if prior is None:
                g = np.concatenate([gp_pos, gu_neg])
            else:
                negative = _loss(-zu).mean() - prior * _loss(-zp).mean()
                if negative >= 0:
                    g = np.concatenate([prior * (gp_pos - gp_neg), gu_neg])
                else:  # over-fitted: take the negative risk back up
                    g = np.concatenate([prior * gp_neg, -gu_neg])
            g = g.astype(np.float32)
            back = np.outer(g, w2) * (1 - hid * hid)
            grads = [x.T @ back + decay * w1, back.sum(0), hid.T @ g + decay * w2, np.array([g.sum()], np.float32)]
            t += 1
            for p, grad, (m, v) in zip(model.layers, grads, state, strict=True):
                m *= 0.9
                m += 0.1 * grad
                v *= 0.999
                v += 0.001 * grad * grad
                p -= 3e-3 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return model


def _averaged(models: list[Model]) -> Model:
    """One network with the mean output of several that share their scaling."""
    w1, b1, w2, b2 = (np.concatenate(x, -1) for x in zip(*(m.layers for m in models), strict=True))
    return Model(models[0].mean, models[0].scale, [w1, b1, w2 / len(models), b2.mean(keepdims=True)])


def estimate_prior(pos: np.ndarray, unl: np.ndarray, seed: int = 7) -> float:
    """Share of positives among unlabelled rows: the smallest bound over all scores.

    Each fold of the rows is scored by a model that has not seen it, so that every row counts once.
    """
    if len(pos) < FOLDS or len(unl) < FOLDS:
        return 0.5
    seen: tuple[list, list] = [], []
    for k in range(FOLDS):
        p, u = np.arange(len(pos)) % FOLDS == k, np.arange(len(unl)) % FOLDS == k
        model = _fit(pos[~p], unl[~u], None, 12, seed + k)
        seen[0].append(model.raw(pos[p]))
        seen[1].append(model.raw(unl[u]))
    p, u = (np.sort(np.concatenate(x)) for x in seen)
    above_p = 1 - np.arange(len(p)) / len(p)
    above_u = 1 - np.searchsorted(u, p) / len(u)
    margin = np.sqrt(0.25 / len(p)) + np.sqrt(0.25 / len(u))
    # the smallest of many ratios is too small by chance; with the margin it is a bound, which few rows widen
    return float(np.clip(((above_u + margin) / above_p).min(), 0.05, 0.99))


def _set_by_trusted(model: Model, pos: np.ndarray) -> Model:
    """The model with its output shifted so that the score ``CUT`` lies well below the trusted positives' outputs.

    A prior that is somewhat too large moves all outputs up and changes no order; the positives, which are known, say where
    their outputs end: ``REACH`` times as far below their median as their lowest twentieth begins.
    """
    z = model.raw(pos)
    middle, low = np.median(z), np.quantile(z, 0.05)
    *layers, b2 = model.layers
    return Model(model.mean, model.scale, [*layers, (b2 - (middle - REACH * (middle - low)) + np.log(CUT / (1 - CUT))).astype(np.float32)])


def fit(pos: np.ndarray, unl: np.ndarray, prior: float | None = None, seed: int = 11) -> tuple[Model | None, float]:
    """The model and the prior it was trained under; no model without rows of both kinds."""
    if not len(pos) or not len(unl):
        return None, 0.5
    prior = estimate_prior(pos, unl) if prior is None else prior
    return _set_by_trusted(_averaged([_fit(pos, unl, prior, 40, seed + k) for k in range(NETWORKS)]), pos), prior


def _drawn(ids: DataFrame, most: int) -> DataFrame:
    """About ``most`` ids at most, by a hash of the id."""
    n = ids.count()
    return ids if n <= most else ids.where(hash_63("doc_id") <= F.lit(last_drawn(most, n)))


def trained(
    docs: DataFrame, labels: DataFrame, learns: Column, most_positive: int = MOST_POSITIVE, most_unlabelled: int = MOST_UNLABELLED
) -> tuple[Model | None, float]:
    """Fit on the rows of ``docs`` (doc_id, text) for which ``learns`` holds; ``labels``: doc_id, quality (1: trusted)."""
    ship(docs.sparkSession)
    ids = docs.select("doc_id").where(learns).where(F.col("doc_id").isNotNull())
    marked = labels.where(F.col("quality").isNotNull()).select("doc_id", "quality")
    positive = _drawn(ids.join(marked.where("quality = 1").select("doc_id").distinct(), "doc_id", "left_semi").distinct(), most_positive)
    unlabelled = _drawn(ids.join(marked.select("doc_id"), "doc_id", "left_anti").distinct(), most_unlabelled)
    # as many ids as the two bounds allow
    drawn = F.broadcast(positive.select("doc_id", F.lit(1).alias("is_positive")).unionByName(unlabelled.select("doc_id", F.lit(0).alias("is_positive"))))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", STEP):
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([x.tobytes() for x in features(part.column(2))], pa.binary())], ["doc_id", "is_positive", "x"])

    rows = docs.select("doc_id", "text").join(drawn, "doc_id").select("doc_id", "is_positive", "text")
    got = rows.mapInArrow(read, "doc_id long, is_positive int, x binary").toArrow().sort_by([(c, "ascending") for c in ("is_positive", "doc_id", "x")])
    is_positive = got["is_positive"].to_numpy() == 1
    x = utf8(got["x"].combine_chunks())[0].view(np.float32).reshape(-1, DIMENSIONS)
    shuffle = np.random.default_rng(3)
    return fit(shuffle.permutation(x[is_positive]), shuffle.permutation(x[~is_positive]))


def scored(docs: DataFrame, model: Model | None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id and score of every row."""
    ship(docs.sparkSession)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", STEP):
                s = np.full(part.num_rows, 0.5) if model is None else model.score(features(part.column(1)))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(s)], ["doc_id", "score"])

    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")).mapInArrow(score, "doc_id long, score double")


def with_score(docs: DataFrame, model: Model | None, score_column: str, text_column: str = "text") -> DataFrame:
    """``docs`` with the score as one more column, rows passing straight through."""
    ship(docs.sparkSession)
    schema = StructType([*docs.schema.fields, StructField(score_column, DoubleType())])
    where = docs.columns.index(text_column)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_column, STEP):
                s = np.full(part.num_rows, 0.5) if model is None else model.score(features(part.column(where)))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(s)], [*part.schema.names, score_column])

    return docs.mapInArrow(score, schema)
