"""Small linear classifiers over hashed features, trained with full-batch Adam on a bounded sample."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Sparse:
    """Rows of 0/1 features: entry k says that row[k] has column col[k]."""

    row: np.ndarray
    col: np.ndarray
    n: int

    def times(self, w: np.ndarray) -> np.ndarray:
        """(n, classes) of a (columns, classes) weight matrix."""
        return np.stack([np.bincount(self.row, weights=w[self.col, c], minlength=self.n) for c in range(w.shape[1])], axis=1)

    def matrix(self, columns: int):
        """Functions that multiply by the matrix and by its transpose, by sums over its entries in either order."""
        by_row, by_col = np.argsort(self.row, kind="stable"), np.argsort(self.col, kind="stable")

        def product(order: np.ndarray, out: np.ndarray, of: np.ndarray, n: int):
            out, of = out[order], of[order]
            first = np.flatnonzero(np.diff(out, prepend=-1))

            def times(w: np.ndarray) -> np.ndarray:
                got = np.zeros((n, w.shape[1]))
                if len(first):
                    got[out[first]] = np.add.reduceat(w[of], first, axis=0)
                return got

            return times

        return product(by_row, self.row, self.col, self.n), product(by_col, self.col, self.row, columns)


def softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(1, keepdims=True))
    return z / z.sum(1, keepdims=True)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(x: Sparse, y: np.ndarray, weight: np.ndarray, columns: int, l2: float, penalty=None, steps: int = 300, rate: float = 0.1) -> tuple[np.ndarray, np.ndarray]:
    """Weights (columns, classes) and intercepts; y: (n, classes), one column for a logistic model, else softmax.

    penalty(w, b) -> gradients of a further term.
    """
    w, b = np.zeros((columns, y.shape[1])), np.zeros(y.shape[1])
    forth, back = x.matrix(columns)
    moments = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(b), np.zeros_like(b)]
    share = weight[:, None] / max(weight.sum(), 1e-9)
    for t in range(1, steps + 1):
        z = forth(w) + b
        r = ((sigmoid(z) if y.shape[1] == 1 else softmax(z)) - y) * share
        grads = [back(r) + l2 * w, r.sum(0)]
        if penalty is not None:
            grads = [g + more for g, more in zip(grads, penalty(w, b))]
        for k, (value, g) in enumerate(((w, grads[0]), (b, grads[1]))):
            m, v = moments[2 * k], moments[2 * k + 1]
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            value -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w, b
