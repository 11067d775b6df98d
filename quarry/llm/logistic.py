"""Weighted logistic regression by Newton's method, for bounded samples."""

from __future__ import annotations

import numpy as np


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, l2: float = 1e-3,
                 intercept: bool = True, steps: int = 40) -> np.ndarray:
    """Coefficients (intercept last, unpenalised) that minimise the mean
    logistic loss plus ``l2`` times the squared coefficients."""
    if intercept:
        x = np.hstack([x, np.ones((len(x), 1))])
    weight = np.ones(len(x)) if weight is None else weight
    penalty = np.full(x.shape[1], 2 * l2 * len(x))
    if intercept:
        penalty[-1] = 1e-9
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - y)) + penalty * w
        hessian = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(penalty + 1e-9)
        step = np.linalg.solve(hessian, gradient)
        step *= min(1.0, 5.0 / (np.abs(step).max() + 1e-12))
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w
