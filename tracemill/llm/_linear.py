"""Sparse logistic regression in numpy, for the classifiers of this subpackage."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


class Rows:
    """Sparse rows: the features of row i are ids[starts[i]:starts[i + 1]], with values."""

    def __init__(self, lists: list, values: list | None = None):
        sizes = [len(x) for x in lists]
        self.starts = np.cumsum([0, *sizes])
        self.ids = np.fromiter((i for x in lists for i in x), np.int64, self.starts[-1])
        self.values = np.fromiter((v for x in values for v in x), float, self.starts[-1]) if values is not None else np.ones(self.starts[-1])
        self.row = np.repeat(np.arange(len(lists)), sizes)
        self.n = len(lists)

    @classmethod
    def of(cls, lists: pa.ListArray) -> Rows:
        """Rows of a column of lists of features, without Python objects."""
        out = cls([])
        starts = lists.offsets.to_numpy().astype(np.int64)
        out.starts, out.n = starts - starts[0], len(lists)
        out.ids = lists.values.to_numpy()[starts[0] : starts[-1]].astype(np.int64)
        out.values = np.ones(len(out.ids))
        out.row = np.repeat(np.arange(out.n), np.diff(starts))
        return out

    def dot(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights[self.ids] * self.values, self.n)

    def transposed(self, by_row: np.ndarray, width: int) -> np.ndarray:
        return np.bincount(self.ids, by_row[self.row] * self.values, width)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit(rows: Rows, labels: np.ndarray, width: int, weight: np.ndarray | None = None, pairs: tuple[Rows, Rows] | None = None, pair_penalty: float = 0.0, pair_weight: np.ndarray | None = None, ridge: float = 1e-4, steps: int = 300, rate: float = 0.3) -> tuple[np.ndarray, float]:
    """Weights and intercept minimising mean log loss + ridge + pair_penalty * mean squared difference of the pairs' scores.

    weight and pair_weight are the shares of rows and pairs in their means. Deterministic full-batch Adam. labels may be soft (0 to 1).
    """
    w, b = np.zeros(width), 0.0
    weight = np.ones(rows.n) if weight is None else weight
    total = max(weight.sum(), 1e-9)
    if pairs is not None:
        share = np.ones(pairs[0].n) if pair_weight is None else pair_weight
        share = share / max(share.sum(), 1e-9)
    m, v = np.zeros(width + 1), np.zeros(width + 1)
    for step in range(1, steps + 1):
        error = (sigmoid(rows.dot(w) + b) - labels) * weight / total
        gradient = np.append(rows.transposed(error, width) + 2 * ridge * w, error.sum())
        if pairs is not None and pairs[0].n:
            one, other = sigmoid(pairs[0].dot(w) + b), sigmoid(pairs[1].dot(w) + b)
            pull = 2 * pair_penalty * (one - other) * share
            one, other = pull * one * (1 - one), pull * other * (1 - other)
            gradient += np.append(pairs[0].transposed(one, width) - pairs[1].transposed(other, width), one.sum() - other.sum())
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w, float(b)
