"""Quality classifier by positive-unlabelled learning.

Trusted positives are documents labelled 1 outside the held-out fold;
documents labelled 0 are never used as negatives: everything outside the
held-out fold is the unlabelled web text. A linear model over features of the
whole text minimises the non-negative unbiased risk

    prior * R+(P) + max(0, R-(U) - prior * R-(P)),

where the prior (the share of good text among the unlabelled) is estimated
first: a model of positives against unlabelled text ranks a second half of
both samples, and the smallest ratio of their shares above a threshold (with
its confidence margin) is the prior.

The model is fitted on bounded samples (``MAX_POSITIVES`` and
``MAX_UNLABELLED`` rows, in expectation), drawn by a hash of doc_id and of
(doc_id, text), the share taken from the rows' own count; repeated rows fold
before they are collected, so null ids, an id with many texts or one row that
makes up a third of the table don't add to them. Every document is scored, in one
pass, by a scalar function of its text alone.

Null and empty texts have zero features and get a score like any other; very
long ones are read in chunks. A repeated label counts as 1 if any of its rows
says 1. Without positives or unlabelled rows every score is the prior's
default. Repeated rows score alike; a score that equals the threshold passes. An
empty table gives no rows. ``keep_good`` returns columns of any name untouched.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import byte_chunks, encoded, hash_share, held_out

MAX_POSITIVES = 10_000
MAX_UNLABELLED = 10_000
THRESHOLD = 0.3
DEFAULT_PRIOR = 0.5
_CLASSES = (b"#*$%&|<>", b"!", b"?", b".,;:", b"0123456789", bytes(range(65, 91)), bytes(range(97, 123)),
            bytes(range(128, 256)), b"\n", b" ", b"()[]{}/\\=_@~^+-\"'`")


def features(text: str | None) -> np.ndarray:
    """Shares and shape of a whole text; chunk by chunk, so a very long text takes no more memory than its words."""
    data = encoded(text)
    histogram, words, n, doubled, last = np.zeros(256, np.int64), Counter(), 0, 0, b""
    for part in byte_chunks(data):
        histogram += np.bincount(np.frombuffer(part, np.uint8), minlength=256)
        split = part.split()
        words.update(split)
        n += len(split)
        doubled += sum(map(eq, split, [last, *split]))  # words equal to the one before
        last = split[-1] if split else last
    lines, dup_lines, seen = 0, 0, set()
    for line in data.split(b"\n"):
        line = line.strip()
        if line:
            lines += 1
            if line in seen:
                dup_lines += 1
            else:
                seen.add(line)
    size = max(1, len(data))
    shares = [histogram[list(c)].sum() / size for c in _CLASSES]
    top = words.most_common(3)
    return np.array([
        *shares, *np.sqrt(shares[:4]),
        np.log1p(n), size / max(1, n) / 10, min(1.0, len(words) / max(1, n)), len(words) / max(1.0, n ** 0.7),
        *(top[k][1] / n if len(top) > k else 0.0 for k in range(3)),
        dup_lines / max(1, lines), min(1.0, 4 * doubled / max(1, n)), n / max(1, lines) / 100, _entropy(histogram) / 8,
        float(n < 20), float(n < 5),
    ])


def _entropy(histogram: np.ndarray) -> float:
    p = histogram[histogram > 0] / max(1, histogram.sum())
    return float(-(p * np.log2(p)).sum())


# ---------------------------------------------------------------- learning
@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _descend(gradient, dim: int, steps: int, rate: float) -> np.ndarray:
    """Adam over all rows."""
    w, m, v = np.zeros(dim), np.zeros(dim), np.zeros(dim)
    for t in range(1, steps + 1):
        g = gradient(w)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def estimate_prior(p: np.ndarray, u: np.ndarray, steps: int = 300) -> float:
    """The share of positives in ``u``: rows alternate between ranking and measuring."""
    a, b = p[::2], u[::2]
    x, y = np.r_[a, b], np.r_[np.ones(len(a)), np.zeros(len(b))]
    weight = np.r_[np.full(len(a), 0.5 / len(a)), np.full(len(b), 0.5 / len(b))]
    w = _descend(lambda w: x.T @ (weight * (_sigmoid(x @ w) - y)) + 1e-4 * w, x.shape[1], steps, 0.05)
    own, other = np.sort(p[1::2] @ w), np.sort(u[1::2] @ w)
    cuts = np.quantile(own, np.linspace(0.02, 0.98, 97))
    above_p = 1 - np.searchsorted(own, cuts) / len(own)
    above_u = 1 - np.searchsorted(other, cuts) / len(other)
    margin = np.sqrt(np.log(4 / 0.1) / 2) * (1 / np.sqrt(len(own)) + 1 / np.sqrt(len(other)))
    best = int(np.argmin((above_u + margin) / above_p))
    return float(np.clip(above_u[best] / above_p[best], 0.05, 0.99))


def fit(p: np.ndarray, u: np.ndarray, steps: int = 600, ridge: float = 1e-4) -> Model:
    """Minimise the non-negative unbiased risk over positives ``p`` and unlabelled ``u`` (feature rows)."""
    dim = len(features(""))
    if len(p) < 4 or len(u) < 4:
        share = DEFAULT_PRIOR
        return Model(np.zeros(dim), np.ones(dim), np.zeros(dim), float(np.log(share / (1 - share))), share)
    mean, scale = u.mean(axis=0), u.std(axis=0) + 1e-6
    standard = lambda x: np.c_[np.clip((x - mean) / scale, -8, 8), np.ones(len(x))]
    p, u = standard(p), standard(u)
    prior = estimate_prior(p, u)

    def gradient(w):
        zp, zu = p @ w, u @ w
        # logistic loss: as a positive log(1 + e^-z), as a negative log(1 + e^z)
        up_p = p.T @ (_sigmoid(zp) - 1) / len(p)
        down_p, down_u = p.T @ _sigmoid(zp) / len(p), u.T @ _sigmoid(zu) / len(u)
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        rest = down_u - prior * down_p
        # a negative risk below zero is overfitting: step back along it instead
        return (prior * up_p + rest if negative >= 0 else -rest) + ridge * np.r_[w[:-1], 0]

    w = _descend(gradient, p.shape[1], steps, 0.05)
    return Model(mean, scale, w[:-1], float(w[-1]), prior)


# ---------------------------------------------------------------- Spark jobs
def _feature_rows(texts: DataFrame) -> np.ndarray:
    @F.pandas_udf("array<double>")
    def shape(text: pd.Series) -> pd.Series:
        return pd.Series([features(t) for t in text])

    rows = texts.select("doc_id", shape("text").alias("x")).distinct().orderBy("doc_id", "x").collect()  # bounded by the samples
    return np.array([r.x for r in rows]).reshape(len(rows), len(features("")))


def train(docs: DataFrame, labels: DataFrame, max_positives: int = MAX_POSITIVES,
          max_unlabelled: int = MAX_UNLABELLED) -> Model:
    """Fit on samples of ``docs`` (doc_id, text) by ``labels`` (doc_id, quality)."""
    known = labels.where(~held_out("doc_id")).groupBy("doc_id").agg(F.max("quality").alias("quality")).where("quality = 1")
    share = max_positives / max(1, known.count())
    trusted = known.where(hash_share(F.col("doc_id"), 1) < share).select("doc_id")
    texts = docs.select("doc_id", "text")
    trusted = F.broadcast(trusted)  # max_positives ids
    n_rows = docs.select("doc_id").join(trusted, "doc_id", "left_semi").count()
    drawn = hash_share(F.xxhash64("doc_id", "text"), 3) < max_positives / max(1, n_rows)  # an id may have any number of rows
    positive = _feature_rows(texts.where(drawn).join(trusted, "doc_id", "left_semi"))
    free = docs.select("doc_id").where(~held_out("doc_id")).count()
    drawn = hash_share(F.xxhash64("doc_id", "text"), 2) < max_unlabelled / max(1, free)
    unlabelled = _feature_rows(texts.where(~held_out("doc_id") & drawn))
    return fit(positive, unlabelled)


def score_column(model: Model, text: str = "text") -> Column:
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        if not len(texts):
            return pd.Series([], dtype=float)
        return pd.Series(model.score(np.array([features(t) for t in texts])))

    return score(F.col(text))


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``."""
    scored = docs.select("doc_id", "text").select("doc_id", score_column(train(docs, labels)).alias("score"))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, with their own columns."""
    return docs.where(score_column(train(docs, labels)) >= threshold)
