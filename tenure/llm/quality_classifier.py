"""Quality from trusted positives and unlabelled text (positive-unlabelled learning).

The classifier minimises the non-negative unbiased risk
``prior * R+(positives) + max(0, R-(unlabelled) - prior * R-(positives))``.  The
class prior is estimated from the data: in any region the unlabelled texts have
at least ``prior`` times the positives' density, so the smallest ratio over the
upper ends of a first score bounds it from above.  The risk uses ``caution`` times that
bound: a prior that is too large hides all negatives in the non-negative part.  Features are shares and counts of the
whole text, each cut into quantile steps, so the score is a sum of step functions.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import logistic, sample_ids, slices

_CLASSES = (" \t\r\x0b\x0c", "\n", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "#*$%&|<>", "!?", ".,;:")
_KIND = np.full(256, len(_CLASSES), np.int64)
_KIND[128:] += 1
for _k, _chars in enumerate(_CLASSES):
    _KIND[[ord(c) for c in _chars]] = _k
_STEPS = 16


def features(text: str) -> list[float]:
    """Shares of character classes, sizes, and how much repeats, over the whole text."""
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    shares = np.zeros(len(_CLASSES) + 2)
    for k in range(0, len(raw), 1 << 20):
        shares += np.bincount(_KIND[raw[k : k + (1 << 20)]], minlength=len(shares))
    shares /= max(1, len(raw))
    words = text.split()
    lines = [x for x in text.split("\n") if x.strip()]
    n, m = len(words), max(1, len(words))
    return [
        *shares,
        math.log1p(n),
        len(raw) / m,
        len(set(words)) / m,
        len(set(zip(words, words[1:]))) / max(1, n - 1),
        len(set(lines)) / max(1, len(lines)),
        n / max(1, len(lines)),
        sum(x[0].isupper() for x in words) / m,
        math.log1p(max(map(len, words), default=0)),
    ]


class Model(NamedTuple):
    edges: list  # of each feature's steps
    weights: np.ndarray
    prior: float


def _steps(x: np.ndarray, edges: list) -> np.ndarray:
    """Number of the step that each value lies on, counted through all features."""
    at, first = np.empty(x.shape, np.int64), 0
    for k, e in enumerate(edges):
        at[:, k] = first + np.searchsorted(e, x[:, k], side="right")
        first += len(e) + 1
    return at


def _sigmoid(g: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(g, -30, 30)))


def class_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Smallest ratio of upper shares (unlabelled to positive), where 30 % of the positives lie."""
    cuts = np.quantile(positive, np.linspace(0.05, 0.7, 40))
    ratio = [(unlabelled >= c).mean() / max((positive >= c).mean(), 1e-9) for c in cuts]
    return float(np.clip(min(ratio, default=0.5), 0.05, 0.98))


def fit(positive: list[str], unlabelled: list[str], **options) -> Model:
    """The classifier from texts."""
    return fit_features([features(t) for t in positive], [features(t) for t in unlabelled], **options)


def fit_features(
    positive: list[list[float]], unlabelled: list[list[float]], rounds: int = 400, rate: float = 0.05, ridge: float = 1e-3, caution: float = 0.85
) -> Model:
    """The classifier from ``features`` of positive and unlabelled texts."""
    if not positive or not unlabelled:
        return Model([], np.zeros(1), 1.0 if positive else 0.5)
    x = np.array([*positive, *unlabelled])
    n = len(positive)
    edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, _STEPS + 1)[1:-1])) for k in range(x.shape[1])]
    at = _steps(x, edges)
    size = sum(len(e) + 1 for e in edges)
    hot = np.zeros((len(x), size), np.float32)
    np.put_along_axis(hot, at, 1, axis=1)

    # each half is scored by what the other half taught
    y, half, g = np.r_[np.ones(n), np.zeros(len(x) - n)], np.arange(len(x)) % 2 == 0, np.zeros(len(x))
    for here in (half, ~half):
        first = logistic(hot[~here].astype(float), y[~here], ridge=5.0, steps=12)
        g[here] = hot[here] @ first[:-1] + first[-1]
    prior = caution * class_prior(g[:n], g[n:])

    p, u = hot[:n], hot[n:]
    w, b = np.zeros(size), 0.0
    moments = np.zeros((2, size + 1))
    for t in range(1, rounds + 1):
        sp, su = _sigmoid(p @ w + b), _sigmoid(u @ w + b)
        # logistic loss: l+ = -log s, l- = -log(1 - s)
        as_negative = -np.log1p(-np.minimum(su, 1 - 1e-9)).mean() - prior * -np.log1p(-np.minimum(sp, 1 - 1e-9)).mean()
        minus = np.r_[u.T @ su, su.sum()] / len(u) - prior * np.r_[p.T @ sp, sp.sum()] / len(p)
        plus = prior * np.r_[p.T @ (sp - 1), (sp - 1).sum()] / len(p)
        # where the risk on negatives turns negative, climb back instead of fitting it
        grad = plus + minus if as_negative >= 0 else -minus
        grad[:-1] += ridge * w
        moments[0] = 0.9 * moments[0] + 0.1 * grad
        moments[1] = 0.999 * moments[1] + 0.001 * grad * grad
        step = rate * (moments[0] / (1 - 0.9**t)) / (np.sqrt(moments[1] / (1 - 0.999**t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return Model(edges, np.r_[w, b], prior)


def _sampled(docs: DataFrame, ids: DataFrame) -> list[list[float]]:
    """Features of a bounded table of ids, taken on executors over whole texts; only the numbers come to the driver."""

    def run(batches):
        for whole in batches:
            for batch in slices(whole, "text"):
                got = [features(x or "") for x in batch.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.list_(pa.float64()))], ["id", "x"])

    rows = docs.select("id", "text").join(F.broadcast(ids), "id")
    found = rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, x array<double>")
    return [r["x"] for r in found.groupBy("id").agg(F.min("x").alias("x")).orderBy("id").collect()]


def learn(docs: DataFrame, labels: DataFrame, positives: int = 6000, unlabelled: int = 12000) -> Model:
    """Fit on the whole texts of at most so many labelled positives and unlabelled documents (those of smallest hash).

    ``docs``: id, text, without held-out rows.  ``labels``: id, quality; only rows with quality 1 are used.
    Of rows that share an id the least features count.
    """
    good = _sampled(docs, sample_ids(labels.where("quality = 1"), positives))
    web = _sampled(docs, sample_ids(docs, unlabelled, salt=1))
    return fit_features(good, web)


def score(df: DataFrame, model: Model, least: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row ``score`` (0 to 1, of the whole text) and ``predicted`` (1 from ``least`` on).

    Null and empty texts are scored as texts without words.  Without labelled positives every
    score is 0.5.  Null ids stay null, repeated rows give a row each, other columns
    are not read, an empty table gives an empty result.
    """

    def run(batches):
        for whole in batches:
            for batch in slices(whole, "text"):
                texts = [x or "" for x in batch.column(1).to_pylist()]
                if model.edges:
                    at = _steps(np.array([features(t) for t in texts]), model.edges)
                    s = _sigmoid(model.weights[at].sum(axis=1) + model.weights[-1])
                else:
                    s = np.full(len(texts), model.prior)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(s, pa.float64()), pa.array((s >= least).astype(np.int32))], ["id", "score", "predicted"]
                )

    src = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    out = src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, score double, predicted int")
    return out.withColumnRenamed("id", id_col)
