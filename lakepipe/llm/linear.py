"""Sparse logistic regression on a bounded sample, in numpy."""

from __future__ import annotations

import numpy as np


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


class Rows:
    """Sparse rows: for each row a run of (column, value)."""

    def __init__(self, columns: np.ndarray, values: np.ndarray, lengths: np.ndarray, width: int):
        self.columns, self.values, self.width = columns.astype(np.int64), values.astype(np.float64), width
        self.of = np.repeat(np.arange(len(lengths)), lengths)
        self.n = len(lengths)

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.of, self.values * w[self.columns], self.n)

    def back(self, g: np.ndarray) -> np.ndarray:
        return np.bincount(self.columns, self.values * g[self.of], self.width)


def fit(
    rows: Rows,
    target: np.ndarray,
    weight: np.ndarray,
    l2: float,
    pairs: Rows | None = None,
    pair_penalty: float = 0.0,
    steps: int = 200,
    rate: float = 0.1,
) -> tuple[np.ndarray, float]:
    """(weights, bias) minimising weighted log loss + l2 |w|^2 + pair_penalty * mean of (pairs . w)^2, by Adam."""
    w, b = np.zeros(rows.width), 0.0
    m, v = np.zeros(rows.width + 1), np.zeros(rows.width + 1)
    total = max(weight.sum(), 1e-9)
    for t in range(1, steps + 1):
        err = weight * (sigmoid(rows.times(w) + b) - target) / total
        g = rows.back(err) + 2 * l2 * w
        if pairs is not None and pairs.n:
            g += 2 * pair_penalty * pairs.back(pairs.times(w)) / pairs.n
        g = np.append(g, err.sum())
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w -= step[:-1]
        b -= step[-1]
    return w, float(b)
