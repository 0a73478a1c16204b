"""Operator 3: quality by positive-unlabelled learning with the non-negative risk estimator.

Trusted positives are documents labelled 1; the unlabelled set is web text without
a label. The class prior is estimated as the share of 1 among the labelled
documents. A small network g over shape features of the whole text minimises

    prior * E_pos[l(g)] + max(0, E_unl[l(-g)] - prior * E_pos[l(-g)]),  l logistic,

and steps back where the second term has gone negative. Its output is then mapped
to a probability by a logistic fit on the labelled sample.

The model is fitted on bounded samples (``max_labelled`` labelled and
``max_unlabelled`` unlabelled documents, first in the order of a hash of the id);
scoring reads every whole text. Neither ids nor labels, lang or source are inputs.

A null text scores as an empty one. Without labelled positives every text scores
0.5. Several labels of one document: the largest counts; null labels do not count.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civic_indicators.llm.common import bounded_ids, fold, fresh, q

# Byte classes: 0 lower, 1 upper, 2 digit, 3 blank, 4 line break, 5 sentence punctuation, 6 other ASCII, 7 non-ASCII.
_CLASS = np.full(256, 6, np.uint8)
for _set, _c in ((b"abcdefghijklmnopqrstuvwxyz", 0), (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", 1), (b"0123456789", 2),
                 (b" \t", 3), (b"\r\n\x0b\x0c", 4), (b".,;:'\"-?()", 5), (bytes(range(128, 256)), 7)):
    _CLASS[list(_set)] = _c
N_FEATURES = 8 + 64 + 10


def features(text: str | None) -> np.ndarray:
    """Shares and shapes of the whole text, none of them its length."""
    b = (text or "").encode("utf-8", "replace")
    out = np.zeros(N_FEATURES, np.float32)
    if not b:
        return out
    c = _CLASS[np.frombuffer(b, np.uint8)]
    out[:8] = np.bincount(c, minlength=8) / len(c)
    if len(c) > 1:
        out[8:72] = np.bincount(c[:-1] * np.uint8(8) + c[1:], minlength=64) / (len(c) - 1)
    w = b.split()
    n = len(w)
    if n:
        lens = np.fromiter(map(len, w), np.int64, n)
        same = sum(map(bytes.__eq__, w[1:], w[:-1]))
        lines = b.split(b"\n")
        out[72:] = (lens.mean() / 10, lens.std() / 10, same / n, len(set(w)) / n, (lens == 1).mean(), (lens > 20).mean(),
                    sum(map(bytes.isupper, w)) / n, sum(map(bytes.isalpha, w)) / n,
                    1 - len(set(lines)) / len(lines), n / len(lines) / 100)
    return out


@dataclass(frozen=True)
class QualityParams:
    max_labelled: int = 20_000
    max_unlabelled: int = 20_000
    hidden: int = 24
    epochs: int = 30
    batch: int = 512
    seed: int = 7


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_nnpu(pos: np.ndarray, unl: np.ndarray, prior: float, p: QualityParams):
    """The network's weights, by Adam on the non-negative risk."""
    rng = np.random.default_rng(p.seed)
    d = pos.shape[1]
    w = [rng.normal(0, 1 / np.sqrt(d), (d, p.hidden)), np.zeros(p.hidden), rng.normal(0, 1 / np.sqrt(p.hidden), p.hidden), np.zeros(1)]
    m, v, step = [np.zeros_like(x) for x in w], [np.zeros_like(x) for x in w], 0

    def back(x, h, dg):
        dh = np.outer(dg, w[2]) * (h > 0)
        return [x.T @ dh, dh.sum(0), h.T @ dg, np.array([dg.sum()])]

    rounds = max(1, min(len(unl), 20_000) // p.batch)
    for _ in range(p.epochs * rounds):
        xp, xu = pos[rng.integers(0, len(pos), p.batch)], unl[rng.integers(0, len(unl), p.batch)]
        hp, hu = np.maximum(xp @ w[0] + w[1], 0), np.maximum(xu @ w[0] + w[1], 0)
        gp, gu = hp @ w[2] + w[3], hu @ w[2] + w[3]
        negative = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
        n = p.batch
        if negative >= 0:
            dp, du = (-prior * _sigmoid(-gp) - prior * _sigmoid(gp)) / n, _sigmoid(gu) / n
        else:  # overfitted: undo the negative part
            dp, du = prior * _sigmoid(gp) / n, -_sigmoid(gu) / n
        grads = [a + b for a, b in zip(back(xp, hp, dp), back(xu, hu, du))]
        step += 1
        for i, g in enumerate(grads):
            g = g + 1e-4 * w[i]
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.999 * v[i] + 0.001 * g * g
            w[i] = w[i] - 2e-3 * (m[i] / (1 - 0.9 ** step)) / (np.sqrt(v[i] / (1 - 0.999 ** step)) + 1e-8)
    return w


def fit_logistic(g: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> tuple[float, float]:
    """Slope and offset of P(y=1 | g), by Newton steps with a small ridge."""
    x = np.stack([g, np.ones_like(g)], 1)
    t = np.zeros(2)
    weight = np.ones_like(g) if weight is None else weight
    for _ in range(50):
        pr = _sigmoid(x @ t)
        grad = x.T @ (weight * (pr - y)) + 1e-3 * t
        step = np.linalg.solve((x * (weight * pr * (1 - pr))[:, None]).T @ x + 1e-3 * np.eye(2), grad)
        t = t - np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-8:
            break
    return float(t[0]), float(t[1])


def train(docs: DataFrame, labels: DataFrame, p: QualityParams = QualityParams(), text: str = "text"):
    """The model as plain arrays, or None without labelled positives.

    ``labels``: (doc_id, y); ``docs``: the documents to learn from.
    """
    labelled = labels.where("y is not null and doc_id is not null").groupBy("doc_id").agg(F.max("y").alias("y"))
    known = bounded_ids(labelled, p.max_labelled, "y")
    ids = docs.select(q("doc_id").cast("bigint").alias("doc_id")).where("doc_id is not null")
    some = bounded_ids(ids, 4 * p.max_unlabelled).join(labels.select("doc_id").distinct(), "doc_id", "left_anti")
    some = bounded_ids(some, p.max_unlabelled).select("doc_id", F.lit(-1).alias("y"))
    sample = known.select("doc_id", F.col("y").cast("int").alias("y")).union(some).dropDuplicates(["doc_id"])

    @F.pandas_udf("binary")
    def feats(t: pd.Series) -> pd.Series:
        return t.map(lambda x: features(x).tobytes())

    got = (docs.select(q("doc_id").cast("bigint").alias("doc_id"), q(text).alias("t")).join(F.broadcast(sample), "doc_id")
           .select("y", feats("t").alias("f")).toPandas())
    if not (got.y == 1).any():
        return None
    x = np.stack([np.frombuffer(f, np.float32) for f in got.f]).astype(np.float64)
    y = got.y.to_numpy()
    mean, std = x.mean(0), x.std(0) + 1e-3
    x = np.clip((x - mean) / std, -8, 8)
    prior = float((y == 1).sum() / (y >= 0).sum())
    unl = x[y == -1] if (y == -1).any() else x
    w = fit_nnpu(x[y == 1], unl, prior, p)
    g = np.maximum(x @ w[0] + w[1], 0) @ w[2] + w[3]
    a, b = fit_logistic(g[y >= 0], (y[y >= 0] == 1).astype(float)) if (y == 0).any() else (1.0, 0.0)
    return [mean, std, *w, np.array([a, b])]


def quality_score(docs: DataFrame, model, text: str = "text") -> Column:
    """P(quality) of the whole text, 0 to 1."""
    if model is None:
        return F.lit(0.5)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(t: pd.Series) -> pd.Series:
        mean, std, w0, b0, w1, b1, ab = shared.value
        x = np.stack([features(v) for v in t]).astype(np.float64) if len(t) else np.zeros((0, N_FEATURES))
        g = np.maximum(np.clip((x - mean) / std, -8, 8) @ w0 + b0, 0) @ w1 + b1
        return pd.Series(_sigmoid(ab[0] * g + ab[1]))

    return score(q(text))


def learn_quality(docs: DataFrame, labels: DataFrame, folds: int = 5, out: int = 0, p: QualityParams = QualityParams(), text: str = "text"):
    """A model from the rows whose fold is not ``out``."""
    y = labels.select(q("doc_id").cast("bigint").alias("doc_id"), q("quality").alias("y"))
    own = fold(F.col("doc_id").cast("bigint"), folds) != out
    return train(docs.where(own), y.where(own), p, text)


def quality(docs: DataFrame, labels: DataFrame, folds: int = 5, out: int = 0, threshold: float = 0.3,
            p: QualityParams = QualityParams(), text: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    model = learn_quality(docs, labels, folds, out, p, text)
    scored = docs.select(q("doc_id").cast("bigint").alias("doc_id"), quality_score(docs, model, text).alias("score"))
    return scored.select("doc_id", (fold(F.col("doc_id"), folds) == out).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_quality(docs: DataFrame, labels: DataFrame, folds: int = 5, out: int = 0, threshold: float = 0.3,
                 p: QualityParams = QualityParams(), text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, all columns kept."""
    model = learn_quality(docs, labels, folds, out, p, text)
    s = fresh(docs, "_score")[0]
    return docs.withColumn(s, quality_score(docs, model, text)).where(F.col(s) >= threshold).drop(s)
