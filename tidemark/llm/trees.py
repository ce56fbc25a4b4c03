"""Small boosted trees on binned features, fitted on a bounded sample."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Leaf:
    value: float


@dataclass
class Split:
    """Rows with feature <= threshold go left."""

    feature: int
    threshold: float
    left: Split | Leaf
    right: Split | Leaf


def boost(
    x: np.ndarray,
    y: np.ndarray,
    weight: np.ndarray | None = None,
    rounds: int = 20,
    depth: int = 3,
    rate: float = 0.3,
    bins: int = 32,
    min_weight: float = 5.0,
    ridge: float = 1.0,
) -> tuple[float, list[Split | Leaf]]:
    """Logistic gradient boosting; the intercept and the trees.

    ``x`` is rows by features without NaN, ``y`` 0 or 1. One class only, or no
    rows, gives trees that change nothing.
    """
    n = len(y)
    weight = np.ones(n) if weight is None else weight
    total = weight.sum()
    if not n or total == 0:
        return 0.0, []
    share = min(max(float((weight * y).sum() / total), 1e-3), 1 - 1e-3)
    start = float(np.log(share / (1 - share)))
    margin = np.full(n, start)
    edges = [_edges(x[:, f], bins) for f in range(x.shape[1])]
    codes = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], axis=1)
    trees: list[Split | Leaf] = []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        gradient, curve = weight * (y - p), weight * p * (1 - p)
        step = np.zeros(n)

        def grow(rows: np.ndarray, levels: int) -> Split | Leaf:
            g, h = gradient[rows].sum(), curve[rows].sum()
            best = (1e-6, -1, -1)
            if levels and weight[rows].sum() >= 2 * min_weight:
                for f, e in enumerate(edges):
                    if not len(e):
                        continue
                    c = codes[rows, f]
                    size = len(e) + 1
                    gl = np.cumsum(np.bincount(c, gradient[rows], size))[:-1]
                    hl = np.cumsum(np.bincount(c, curve[rows], size))[:-1]
                    wl = np.cumsum(np.bincount(c, weight[rows], size))[:-1]
                    gain = gl**2 / (hl + ridge) + (g - gl) ** 2 / (h - hl + ridge) - g**2 / (h + ridge)
                    gain[(wl < min_weight) | (weight[rows].sum() - wl < min_weight)] = -1
                    at = int(np.argmax(gain))
                    if gain[at] > best[0]:
                        best = (float(gain[at]), f, at)
            if best[1] < 0:
                value = float(rate * g / (h + ridge))
                step[rows] = value
                return Leaf(value)
            _, f, at = best
            left = codes[rows, f] <= at
            return Split(f, float(edges[f][at]), grow(rows[left], levels - 1), grow(rows[~left], levels - 1))

        trees.append(grow(np.arange(n), depth))
        margin += step
    return start, trees


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    """Thresholds halfway between neighbouring quantiles."""
    q = np.unique(np.quantile(values, np.linspace(0, 1, bins + 1), method="nearest"))
    return (q[:-1] + q[1:]) / 2


Condition = tuple[int, bool, float]  # feature, whether above the threshold, threshold


def paths(tree: Split | Leaf, above: tuple[Condition, ...] = ()) -> list[tuple[Condition, ...]]:
    """The conditions that lead to every node below the root."""
    if isinstance(tree, Leaf):
        return []
    out = []
    for side, over in ((tree.left, False), (tree.right, True)):
        path = tuple(c for c in above if c[:2] != (tree.feature, over)) + ((tree.feature, over, tree.threshold),)
        out += [tuple(sorted(path)), *paths(side, path)]
    return out
