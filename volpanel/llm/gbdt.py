"""Gradient-boosted trees for a binary label: logistic loss, Newton leaves, exact cuts on a grid of
quantiles.  Small and deterministic; fitted on bounded samples only."""

from __future__ import annotations

import numpy as np

BINS = 32


def cut_points(x: np.ndarray, bins: int = BINS) -> list[np.ndarray]:
    """Per feature: midpoints between neighbouring distinct values, thinned to quantiles."""
    out = []
    for k in range(x.shape[1]):
        v = np.unique(x[:, k])
        mid = (v[1:] + v[:-1]) / 2
        if len(mid) > bins:
            mid = np.unique(np.quantile(x[:, k], np.linspace(0, 1, bins + 2)[1:-1]))
        out.append(mid)
    return out


def fit(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 4, rate: float = 0.2, ridge: float = 1.0, least: int = 8, weight: np.ndarray | None = None) -> dict:
    """{"base": log odds, "trees": [...]}; a node is [feature, cut, left, right] or a leaf's value.

    Rows with x <= cut go left."""
    weight = np.ones(len(y)) if weight is None else weight
    p0 = np.clip((weight * y).sum() / weight.sum(), 1e-3, 1 - 1e-3)
    score = np.full(len(y), np.log(p0 / (1 - p0)))
    cuts = cut_points(x)
    codes = np.stack([np.searchsorted(c, x[:, k], "left") for k, c in enumerate(cuts)], axis=1)
    model = {"base": float(score[0]), "trees": []}
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = weight * (y - p), weight * p * (1 - p)

        def grow(rows: np.ndarray, level: int):
            total_g, total_h = g[rows].sum(), h[rows].sum()
            leaf = rate * total_g / (total_h + ridge)
            if level == depth or len(rows) < 2 * least:
                score[rows] += leaf
                return float(leaf)
            best = (1e-6, -1, -1)
            for k, c in enumerate(cuts):
                if not len(c):
                    continue
                own = codes[rows, k]
                gs = np.cumsum(np.bincount(own, g[rows], len(c) + 1))[:-1]
                hs = np.cumsum(np.bincount(own, h[rows], len(c) + 1))[:-1]
                ns = np.cumsum(np.bincount(own, minlength=len(c) + 1))[:-1]
                gain = gs**2 / (hs + ridge) + (total_g - gs) ** 2 / (total_h - hs + ridge) - total_g**2 / (total_h + ridge)
                gain[(ns < least) | (len(rows) - ns < least)] = 0
                i = int(np.argmax(gain))
                if gain[i] > best[0]:
                    best = (float(gain[i]), k, i)
            if best[1] < 0:
                score[rows] += leaf
                return float(leaf)
            _, k, i = best
            left = codes[rows, k] <= i
            return [k, float(cuts[k][i]), grow(rows[left], level + 1), grow(rows[~left], level + 1)]

        model["trees"].append(grow(np.arange(len(y)), 0))
    return model


def predict(model: dict, x: np.ndarray) -> np.ndarray:
    """Log odds of each row."""
    out = np.full(len(x), model["base"])

    def walk(node, rows):
        if not len(rows):
            return
        if isinstance(node, float):
            out[rows] += node
            return
        k, cut, left, right = node
        go = x[rows, k] <= cut
        walk(left, rows[go])
        walk(right, rows[~go])

    for tree in model["trees"]:
        walk(tree, np.arange(len(x)))
    return out


def calibrate(score: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Platt's sigmoid: (a, b) with P(y = 1) = 1 / (1 + exp(-(a * score + b))), fitted on held-out scores."""
    a, b = 1.0, 0.0
    n1, n0 = y.sum(), len(y) - y.sum()
    t = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a * score + b, -30, 30)))
        w = p * (1 - p) + 1e-9
        grad = np.array([((t - p) * score).sum(), (t - p).sum()])
        hess = np.array([[(w * score * score).sum() + 1e-6, (w * score).sum()], [(w * score).sum(), w.sum() + 1e-6]])
        step = np.linalg.solve(hess, grad)
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(a), float(b)
