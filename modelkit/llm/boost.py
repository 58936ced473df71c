"""Gradient-boosted trees for two classes, kept as flat numpy node arrays.

Every tree is a complete binary tree in heap order: inner node i has the children 2i + 1 and 2i + 2, a
feature and a threshold; a row goes right if its value is above the threshold. An inner node that was
not worth splitting sends all rows left. Scoring is then one gather per level for all rows at once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray
    leaf: np.ndarray  # trees x leaves
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        rows = np.arange(len(x))
        total = np.full(len(x), self.base)
        inner = self.feature.shape[1]
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            while node.size and node[0] < inner:
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += leaf[node - inner] if node.size else 0.0
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-self.margin(x)))


def fit(
    x: np.ndarray,
    y: np.ndarray,
    monotone: Sequence[int],
    trees: int = 40,
    depth: int = 4,
    rate: float = 0.2,
    bins: int = 64,
    least: float = 1.0,
    shrink: float = 1.0,
) -> Trees:
    """Fit on histograms of ``bins`` quantiles with logistic loss.

    ``monotone`` has -1, 0 or 1 per feature: the score may not rise (-1) or fall (1) as that feature grows.
    A split that breaks its constraint is not taken, and the value between its two sides bounds all nodes
    below, so the whole model is monotone. ``least`` is the smallest sum of second derivatives of a node.
    """
    n, m = x.shape
    inner, last = 2**depth - 1, 2**depth
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(m)]
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], 1)
    share = min(max(float(y.mean()), 1e-6), 1 - 1e-6)
    model = Trees(np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, last)), float(np.log(share / (1 - share))))
    score = np.full(n, model.base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-score))
        grad, hess = p - y, np.maximum(p * (1 - p), 1e-9)
        node = np.zeros(n, np.int64)
        low, high = np.full(inner + last, -np.inf), np.full(inner + last, np.inf)
        for i in range(inner):
            here = np.flatnonzero(node == i)
            low[2 * i + 1], high[2 * i + 1] = low[i], high[i]
            low[2 * i + 2], high[2 * i + 2] = low[i], high[i]
            best, at = 1e-6, None
            g, h = grad[here], hess[here]
            if h.sum() >= 2 * least:
                whole = g.sum() ** 2 / (h.sum() + shrink)
                for j in range(m):
                    if len(edges[j]) == 0:
                        continue
                    gl = np.cumsum(np.bincount(binned[here, j], g, len(edges[j]) + 1))[:-1]
                    hl = np.cumsum(np.bincount(binned[here, j], h, len(edges[j]) + 1))[:-1]
                    gr, hr = g.sum() - gl, h.sum() - hl
                    left = np.clip(-gl / (hl + shrink), low[i], high[i])
                    right = np.clip(-gr / (hr + shrink), low[i], high[i])
                    gain = gl**2 / (hl + shrink) + gr**2 / (hr + shrink) - whole
                    gain[(hl < least) | (hr < least) | (monotone[j] * (right - left) < 0)] = -np.inf
                    k = int(np.argmax(gain))
                    if gain[k] > best:
                        best, at = gain[k], (j, k, (left[k] + right[k]) / 2)
            right_rows = np.zeros(len(here), bool)
            if at is not None:
                j, k, between = at
                model.feature[t, i], model.threshold[t, i] = j, edges[j][k]
                right_rows = binned[here, j] > k
                if monotone[j]:
                    up, down = (2 * i + 2, 2 * i + 1) if monotone[j] > 0 else (2 * i + 1, 2 * i + 2)
                    low[up], high[down] = between, between
            node[here] = 2 * i + 1 + right_rows
        g = np.bincount(node - inner, grad, last)
        h = np.bincount(node - inner, hess, last)
        model.leaf[t] = rate * np.clip(-g / (h + shrink), low[inner:], high[inner:])
        score += model.leaf[t][node - inner]
    return model
