"""Logistic regression of bounded samples, fitted with NumPy on the driver."""

from __future__ import annotations

import numpy as np


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def fit_logistic(
    x: np.ndarray, target: np.ndarray, weight: np.ndarray | None = None, penalty: float = 1.0, rounds: int = 200
) -> tuple[np.ndarray, float]:
    """(weights, bias) that minimise weighted log loss to soft targets plus penalty/2 times squared weights.

    Accelerated gradient steps on the mean loss; ``x`` may be dense or any matrix with @ and .T.
    """
    n, m = x.shape
    weight = np.ones(n) if weight is None else weight
    total = max(weight.sum(), 1e-9)
    w, bias, w_ahead, b_ahead, t = np.zeros(m), 0.0, np.zeros(m), 0.0, 1.0
    # a bound of the curvature by power iteration
    v = np.full(m, 1 / np.sqrt(max(m, 1)))
    top = 1.0
    for _ in range(20):
        u = x.T @ (weight * (x @ v)) / total
        top = float(np.linalg.norm(u)) or 1.0
        v = u / top
    step = 1 / (0.25 * (1.1 * top + 1) + penalty / total)
    for _ in range(rounds):
        error = weight * (sigmoid(x @ w_ahead + b_ahead) - target) / total
        new_w = w_ahead - step * (x.T @ error + penalty / total * w_ahead)
        new_b = b_ahead - step * error.sum()
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        w_ahead, b_ahead = new_w + (t - 1) / t_next * (new_w - w), new_b + (t - 1) / t_next * (new_b - bias)
        w, bias, t = new_w, new_b, t_next
    return w, float(bias)


class Sparse:
    """Rows of (column, value) pairs with the two products that fitting needs."""

    def __init__(self, rows: list[dict[int, float]], columns: int):
        self.shape = (len(rows), columns)
        self.row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        self.column = np.fromiter((c for r in rows for c in r), np.int64)
        self.value = np.fromiter((v for r in rows for v in r.values()), float)

    def __matmul__(self, w):
        return np.bincount(self.row, self.value * w[self.column], self.shape[0])

    @property
    def T(self):
        turned = Sparse.__new__(Sparse)
        turned.shape, turned.row, turned.column, turned.value = self.shape[::-1], self.column, self.row, self.value
        return turned
