"""Small linear models for bounded training samples: indicators in, probabilities out."""

from __future__ import annotations

import re
import zlib

import numpy as np

TOKENS = re.compile(r"\w+|[^\w\s]+")
WIDTH = 1 << 18      # hashed features


def bucket(feature: str, width: int = WIDTH) -> int:
    return zlib.crc32(feature.encode("utf-8", "surrogatepass")) & (width - 1)


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


class Rows:
    """Rows of distinct indicator features; work goes row by row, so memory stays that of the indices."""

    def __init__(self, features: list[np.ndarray]):
        self.cols = features
        self.n = len(features)

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.array([w[f].sum() for f in self.cols], dtype=np.float64)

    def count(self, rows: np.ndarray, width: int) -> np.ndarray:
        """In how many of the chosen rows each feature is."""
        out = np.zeros(width)
        for i in np.flatnonzero(rows):
            out[self.cols[i]] += 1
        return out

    def pick(self, rows: np.ndarray) -> "Rows":
        return Rows([self.cols[i] for i in rows])


def log_count_ratio(rows: Rows, y: np.ndarray, width: int, alpha: float = 1.0) -> np.ndarray:
    """log((p/|p|) / (q/|q|)) of smoothed feature counts in the classes 1 and 0."""
    p = alpha + rows.count(y == 1, width)
    q = alpha + rows.count(y == 0, width)
    return np.log((p / max((y == 1).sum(), 1)) / (q / max((y == 0).sum(), 1)))


def hinge(rows: Rows, y: np.ndarray, scale: np.ndarray, dense: np.ndarray | None = None,
          c: float = 1.0, rounds: int = 12, seed: int = 7) -> tuple[np.ndarray, np.ndarray, float]:
    """Dual coordinate descent for the linear hinge loss: weights, dense weights, bias.

    Row i is its indicators times ``scale`` with length one, the dense columns and a
    constant feature.  Each step moves one dual variable to its optimum within [0, C];
    C is weighted so that both classes weigh the same.
    """
    dense = np.zeros((rows.n, 0)) if dense is None else dense
    w, v, bias, sign = np.zeros(len(scale)), np.zeros(dense.shape[1]), 0.0, np.where(y == 1, 1.0, -1.0)
    weight = {1.0: c * rows.n / max(2 * (sign > 0).sum(), 1), -1.0: c * rows.n / max(2 * (sign < 0).sum(), 1)}
    cols = rows.cols
    vals = [(scale[f] / max(np.linalg.norm(scale[f]), 1e-9)).astype(np.float32) for f in cols]
    square = np.array([float(x @ x) + 1.0 for x in vals]) + (dense ** 2).sum(axis=1)
    alpha, rng = np.zeros(rows.n), np.random.default_rng(seed)
    for _ in range(rounds):
        moved = 0.0
        for i in rng.permutation(rows.n):
            slope = sign[i] * (w[cols[i]] @ vals[i] + dense[i] @ v + bias) - 1
            new = min(max(alpha[i] - slope / square[i], 0.0), weight[sign[i]])
            if (step := new - alpha[i]) != 0.0:
                w[cols[i]] += step * sign[i] * vals[i]      # features of a row are distinct
                v += step * sign[i] * dense[i]
                bias += step * sign[i]
                alpha[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return w, v, bias


def calibrate(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a sigmoid from margins to the probability of class 1 (Newton steps)."""
    n1, n0 = (y == 1).sum(), (y == 0).sum()
    t = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = sigmoid(a * margin + b)
        g = np.array([((p - t) * margin).sum() + 1e-3 * a, (p - t).sum() + 1e-3 * b])
        v = p * (1 - p)
        h = np.array([[(v * margin * margin).sum() + 1e-3, (v * margin).sum()],
                      [(v * margin).sum(), v.sum() + 1e-3]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return max(float(a), 1e-3), float(b)
