"""Quality by ordinal regression on graded ratings.

A cumulative-link model: one weight vector over hashed features of the text is shared by all grades, and the ordered
thresholds between the grades turn its score into the chance of each grade. This gives an expected grade, and for selection
the chance of at least a wanted grade.

The features are hashed words and prefixes of words, and ten numbers about the layout, cut into steps. At most `fit_rows`
rated rows are fitted, chosen by a hash of their id; every text is scored.

Defined results: null and empty texts get the score of a text without words; grades that the sample lacks get thresholds next
to their neighbour's; without rated rows every text has an even chance of each grade; equal texts get equal scores; of several
ratings of a document the largest counts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isobar.llm.features import BITS, labelled_sample, linear, matrix, normal_words, shapes, telling_features

STEPS = 12
SHAPES = 10


def _steps(shape: np.ndarray) -> np.ndarray:
    """The layout numbers as soft steps: each value is shared by the two steps next to it."""
    out = np.zeros((len(shape), SHAPES, STEPS + 1), np.float32)
    at = np.clip(shape, 0, 1) * (STEPS - 1)
    low = np.floor(at).astype(int)
    row, column = np.indices(shape.shape)
    np.add.at(out, (row, column, low), 1 - (at - low))
    np.add.at(out, (row, column, low + 1), at - low)
    return out[:, :, :STEPS].reshape(len(shape), SHAPES * STEPS)


def _layout(texts: pa.Array) -> np.ndarray:
    return np.concatenate([*(shapes(w) for w in normal_words(texts)), np.zeros((0, SHAPES))])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class OrdinalModel:
    """P(grade > k) = sigmoid(score - threshold[k]); thresholds ascend."""

    weights: np.ndarray
    layout: np.ndarray
    thresholds: np.ndarray

    def tails(self, texts: pa.Array) -> np.ndarray:
        """Chance of more than each grade but the last."""
        parts = [linear(w, self.weights) + _steps(shapes(w)) @ self.layout for w in normal_words(texts)]
        return _sigmoid(np.concatenate([*parts, np.zeros(0)])[:, None] - self.thresholds)


def fit_cumulative(x: np.ndarray, grade: np.ndarray, grades: int, ridge: float, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Shared weights and ordered thresholds by gradient steps with moments; gaps between thresholds stay positive."""
    n, d = x.shape
    share = np.clip([(grade > k).mean() for k in range(grades - 1)], 1e-3, 1 - 1e-3)
    theta = np.maximum.accumulate(-np.log(share / (1 - share)) + 1e-3 * np.arange(grades - 1))
    value = np.concatenate([np.zeros(d), theta[:1], np.log(np.diff(theta) + 1e-3)]).astype(np.float32)
    mean, square = np.zeros_like(value), np.zeros_like(value)
    for step in range(1, rounds + 1):
        weight, gaps = value[:d], np.exp(np.clip(value[d + 1 :], -12, 6))
        theta = value[d] + np.concatenate(([0], np.cumsum(gaps)))
        edge = np.concatenate(([-np.inf], theta, [np.inf]))
        score = x @ weight
        upper, lower = _sigmoid(edge[grade + 1] - score), _sigmoid(edge[grade] - score)
        upper[grade == grades - 1], lower[grade == 0] = 1, 0
        # The loss is -log(upper - lower); this is its slope in the score.
        slope = (1 - upper - lower).astype(np.float32)
        gain = np.maximum(upper - lower, 1e-9)
        d_upper, d_lower = upper * (1 - upper) / gain, lower * (1 - lower) / gain
        by_theta = np.array([(-d_upper[grade == k]).sum() + d_lower[grade == k + 1].sum() for k in range(grades - 1)]) / n
        tail = np.cumsum(by_theta[::-1])[::-1]
        gradient = np.concatenate([x.T @ slope / n + ridge * weight, tail[:1], tail[1:] * gaps]).astype(np.float32)
        mean, square = 0.9 * mean + 0.1 * gradient, 0.99 * square + 0.01 * gradient**2
        rate = 0.05 / (1 + step / rounds * 9)
        value = value - rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    theta = value[d] + np.concatenate(([0], np.cumsum(np.exp(np.clip(value[d + 1 :], -12, 6)))))
    return value[:d], theta


def fit_ordinal(
    documents: DataFrame,
    ratings: DataFrame,
    grade: Column,
    grades: int,
    train: Column | None = None,
    fit_rows: int = 8192,
    features: int = 1536,
    support: int = 8,
    ridge: float = 3e-4,
    rounds: int = 400,
    seed: int = 11,
    text: str = "text",
    doc_id: str = "doc_id",
) -> OrdinalModel:
    """`grade` is a column of `ratings` from 0 to `grades` - 1; null ratings are left out."""
    train = F.lit(True) if train is None else train
    sample = labelled_sample(documents, ratings, grade, train, fit_rows, seed, text, doc_id)
    dims = telling_features(sample, features, support)
    x, given, layout = matrix(sample, dims, _layout)
    weights = np.zeros(1 << BITS, np.float32)
    if not len(x):
        even = np.arange(1, grades) / grades
        return OrdinalModel(weights, np.zeros(SHAPES * STEPS), np.log(even / (1 - even)))
    both = np.concatenate([x, _steps(layout)], 1)
    found, thresholds = fit_cumulative(both, given, grades, ridge, rounds)
    weights[dims] = found[: len(dims)]
    return OrdinalModel(weights, found[len(dims) :], thresholds)


def rating_column(model: OrdinalModel, text: Column) -> Column:
    """A list: the expected grade, then the chance of at least grade 1, 2 and so on."""
    @F.arrow_udf("array<double>")
    def rate(texts: pa.Array) -> pa.Array:
        tails = model.tails(texts)
        return pa.array(list(np.concatenate([tails.sum(1, keepdims=True), tails], 1)), pa.list_(pa.float64()))

    return rate(text)
