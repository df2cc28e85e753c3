"""Maximum-likelihood fits whose sums run over the cluster.

The driver holds a handful of parameters. Each step sends a batch of candidate points
to the data: every task adds up the log-likelihood of its rows at all points, and one
row per point comes back. A step is a damped Newton step with derivatives from
differences, in the logarithms of the (positive) parameters.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

STEP = 1e-3
DAMPING = (0.0, 1e-3, 1e-2, 1e-1, 1.0, 10.0, 100.0, 1000.0)

# Coefficients of Stirling's series for the log-gamma function.
STIRLING = (1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188)
HALF_LOG_TWO_PI = 0.9189385332046727


def log_gamma(x) -> np.ndarray:
    """Log-gamma of positive numbers: shift up to 8 or more, then Stirling's series."""
    x = np.array(x, dtype=float)
    shift = np.zeros_like(x)
    for _ in range(8):
        low = x < 8.0
        shift = shift - np.where(low, np.log(np.where(low, x, 1.0)), 0.0)
        x = np.where(low, x + 1.0, x)
    inverse = 1.0 / x
    tail = sum(c * inverse ** (2 * i + 1) for i, c in enumerate(STIRLING))
    return (x - 0.5) * np.log(x) - x + HALF_LOG_TWO_PI + tail + shift


Likelihood = Callable[[pd.DataFrame, np.ndarray], np.ndarray]


def mean_log_likelihood(data: DataFrame, likelihood: Likelihood, points: np.ndarray) -> np.ndarray:
    """Weighted mean log-likelihood of ``data`` (with a ``weight`` column) per point."""

    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums, weights = np.zeros(len(points)), 0.0
        for batch in batches:
            w = batch["weight"].to_numpy(float)
            weights += w.sum()
            for i, point in enumerate(points):
                sums[i] += float(np.dot(likelihood(batch, point), w))
        yield pd.DataFrame({"point": range(len(points)), "ll": sums, "weight": weights})

    parts = data.mapInPandas(add_up, "point int, ll double, weight double")
    rows = parts.groupBy("point").agg(F.sum("ll").alias("ll"), F.sum("weight").alias("w")).collect()
    out = np.full(len(points), -np.inf)
    for r in rows:
        if r.w and np.isfinite(r.ll):
            out[r.point] = r.ll / r.w
    return out


def _stencil(at: np.ndarray) -> tuple[np.ndarray, dict]:
    """The points needed for the gradient and the matrix of second derivatives."""
    k = len(at)
    points, where = [at], {}
    for i in range(k):
        for s in (1, -1):
            where[(i, s)] = len(points)
            points.append(at + s * STEP * np.eye(k)[i])
    for i in range(k):
        for j in range(i):
            for s in (1, -1):
                for t in (1, -1):
                    where[(i, s, j, t)] = len(points)
                    points.append(at + STEP * (s * np.eye(k)[i] + t * np.eye(k)[j]))
    return np.array(points), where


def maximise(
    data: DataFrame,
    likelihood: Likelihood,
    start: list[float],
    penalty: float,
    tolerance: float = 1e-9,
    steps: int = 200,
) -> np.ndarray:
    """Positive parameters that minimise minus the mean log-likelihood plus a squared penalty.

    The fit ends when no step gains more than ``tolerance``; it fails if that takes more than ``steps``.
    """

    def cost(logs: np.ndarray) -> np.ndarray:
        params = np.exp(np.clip(logs, -30, 30))
        ll = mean_log_likelihood(data, likelihood, params)
        return np.where(np.isfinite(ll), -ll + penalty * (params**2).sum(axis=1), np.inf)

    at = np.log(np.array(start, dtype=float))
    k = len(at)
    for _ in range(steps):
        points, where = _stencil(at)
        f = cost(points)
        grad = np.array([(f[where[(i, 1)]] - f[where[(i, -1)]]) / (2 * STEP) for i in range(k)])
        curve = np.zeros((k, k))
        for i in range(k):
            curve[i, i] = (f[where[(i, 1)]] - 2 * f[0] + f[where[(i, -1)]]) / STEP**2
            for j in range(i):
                mixed = sum(s * t * f[where[(i, s, j, t)]] for s in (1, -1) for t in (1, -1))
                curve[i, j] = curve[j, i] = mixed / (4 * STEP**2)
        values, vectors = np.linalg.eigh(curve)
        size = np.maximum(np.abs(values), 1e-8)
        tries = []
        for d in DAMPING:
            move = -vectors @ ((vectors.T @ grad) / (size + d))
            tries.append(at + move * min(1.0, 2.0 / max(np.abs(move).max(), 1e-12)))
        found = cost(np.array(tries))
        best = int(np.argmin(found))
        if not found[best] < f[0] - tolerance:
            return np.exp(at)
        at = tries[best]
    raise RuntimeError(f"the fit still gains after {steps} steps")
