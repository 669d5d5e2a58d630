"""Linear support vector machines and a logistic calibration for bounded training samples."""

from __future__ import annotations

import numpy as np


def train_svm(x: np.ndarray, y: np.ndarray, c: float = 1.0, epochs: int = 20, seed: int = 7) -> np.ndarray:
    """Weights (last one the bias) of an L1-loss linear SVM by dual coordinate descent.

    ``y`` is +1 / -1; each class has the same total cost, whatever its size.
    """
    x = np.hstack([x, np.ones((len(x), 1), dtype=x.dtype)])
    pos = max(1, int((y > 0).sum()))
    neg = max(1, len(y) - pos)
    upper = np.where(y > 0, c * len(y) / (2 * pos), c * len(y) / (2 * neg))
    square = np.maximum((x * x).sum(axis=1), 1e-9)
    alpha, w = np.zeros(len(y)), np.zeros(x.shape[1])
    order, rng = np.arange(len(y)), np.random.default_rng(seed)
    for _ in range(epochs):
        rng.shuffle(order)
        moved = 0.0
        for i in order:
            g = y[i] * float(x[i] @ w) - 1.0
            new = min(max(alpha[i] - g / square[i], 0.0), upper[i])
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x[i]
                moved += abs(new - alpha[i])
                alpha[i] = new
        if moved < 1e-4 * len(y):
            break
    return w


def fit_logistic(margin: np.ndarray, label: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """(slope, shift) with P(label) = 1 / (1 + exp(-(slope * margin + shift))); targets smoothed by class size."""
    n1, n0 = float((label > 0).sum()), float((label <= 0).sum())
    target = np.where(label > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        d, h = p - target, np.maximum(p * (1 - p), 1e-9)
        g = np.array([(d * margin).sum() + 1e-3 * a, d.sum()])
        m = np.array([[(h * margin * margin).sum() + 1e-3, (h * margin).sum()], [(h * margin).sum(), h.sum() + 1e-6]])
        step = np.linalg.solve(m, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return max(float(a), 1e-6), float(b)


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))
