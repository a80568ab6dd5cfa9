"""Sparse logistic regression by follow-the-regularised-leader updates."""

from __future__ import annotations

import numpy as np


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0)))


class Ftrl:
    """Per-coordinate FTRL-proximal over ``size`` features; feature 0 is the
    bias. An example is (distinct indices, values)."""

    def __init__(self, size: int, alpha: float = 0.1, beta: float = 1.0, l1: float = 0.5, l2: float = 1.0):
        self.z, self.n = np.zeros(size), np.zeros(size)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, idx=slice(None)) -> np.ndarray:
        z, root = self.z[idx], np.sqrt(self.n[idx])
        w = -(z - np.sign(z) * self.l1) / ((self.beta + root) / self.alpha + self.l2)
        w[np.abs(z) <= self.l1] = 0.0
        if isinstance(idx, slice):
            w[0] = -self.z[0] / ((self.beta + np.sqrt(self.n[0])) / self.alpha)  # the bias is not shrunk
        elif len(idx) and idx[0] == 0:
            w[0] = -z[0] / ((self.beta + root[0]) / self.alpha)
        return w

    def update(self, idx: np.ndarray, val: np.ndarray, y: float, weight: float = 1.0) -> None:
        w = self.weights(idx)
        g = weight * (sigmoid(w @ val) - y) * val
        n = self.n[idx]
        more = n + g * g
        self.z[idx] += g - (np.sqrt(more) - np.sqrt(n)) / self.alpha * w
        self.n[idx] = more


def train(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, size: int, passes: int, seed: int = 7,
          weight: np.ndarray | None = None, **kw) -> np.ndarray:
    """Weights after ``passes`` seeded orders of the examples."""
    model = Ftrl(size, **kw)
    order = np.random.default_rng(seed)
    for _ in range(passes):
        for i in order.permutation(len(rows)):
            model.update(*rows[i], float(y[i]), 1.0 if weight is None else float(weight[i]))
    return model.weights()
