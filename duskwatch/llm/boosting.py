"""Gradient-boosted trees for a few classes, in numpy.

Newton boosting of the softmax loss with histograms: features are cut into bins once, each tree
is grown level by level to a fixed depth, and the best cut of a node is read off cumulated sums.
For bounded training sets; prediction is vectorised over rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Forest:
    """Complete trees of one depth: ``feature`` and ``cut`` by tree and inner node."""

    feature: np.ndarray  # trees x inner nodes
    cut: np.ndarray  # go right where the value is above
    leaf: np.ndarray  # trees x leaves
    classes: int
    start: np.ndarray  # of the scores

    def log_probabilities(self, x: np.ndarray) -> np.ndarray:
        scores = np.repeat(self.start[None, :], len(x), axis=0)
        depth = int(np.log2(self.leaf.shape[1]))
        rows = np.arange(len(x))
        for t in range(len(self.feature)):
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (x[rows, self.feature[t, at]] > self.cut[t, at])
            scores[:, t % self.classes] += self.leaf[t, at - self.feature.shape[1]]
        scores -= scores.max(axis=1, keepdims=True)
        return scores - np.log(np.exp(scores).sum(axis=1, keepdims=True))


def _cuts(x: np.ndarray, bins: int) -> list[np.ndarray]:
    """Values between which each feature is cut."""
    out = []
    for column in x.T:
        values = np.unique(column)
        if len(values) > bins:
            values = np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)))
        out.append((values[1:] + values[:-1]) / 2)
    return out


def fit(
    x: np.ndarray, y: np.ndarray, classes: int, *, rounds: int = 24, depth: int = 4, rate: float = 0.3,
    penalty: float = 1.0, bins: int = 24,
) -> Forest:
    """A forest that tells ``y`` (0 to classes - 1) from the rows of ``x``."""
    cuts = _cuts(x, bins)
    binned = np.stack([np.searchsorted(c, col) for c, col in zip(cuts, x.T)]).astype(np.int64)
    width = max((len(c) for c in cuts), default=0) + 1
    counts = np.bincount(y, minlength=classes) + 1.0
    start = np.log(counts / counts.sum())
    scores = np.repeat(start[None, :], len(y), axis=0)
    inner = 2**depth - 1
    feature, cut, leaf = [], [], []
    target = np.eye(classes)[y]
    for _ in range(rounds):
        p = np.exp(scores - scores.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        for c in range(classes):
            g, h = p[:, c] - target[:, c], np.maximum(p[:, c] * (1 - p[:, c]), 1e-6)
            f, t = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf)
            at = np.zeros(len(y), dtype=np.int64)
            for level in range(depth):
                first, nodes = 2**level - 1, 2**level
                local = at - first
                gain, where = np.zeros(nodes), np.zeros((nodes, 2), dtype=np.int64)
                for j in range(len(cuts)):
                    if not len(cuts[j]):
                        continue
                    cell = local * width + binned[j]
                    sums = [
                        np.bincount(cell, weights=w, minlength=nodes * width).reshape(nodes, width).cumsum(1)
                        for w in (g, h)
                    ]
                    gl, hl = sums[0][:, :-1], sums[1][:, :-1]
                    gr, hr = sums[0][:, -1:] - gl, sums[1][:, -1:] - hl
                    all_ = sums[0][:, -1:] ** 2 / (sums[1][:, -1:] + penalty)
                    won = gl**2 / (hl + penalty) + gr**2 / (hr + penalty) - all_
                    won[(hl < 0.5) | (hr < 0.5)] = 0
                    best = won.argmax(1)
                    value = won[np.arange(nodes), best]
                    better = value > gain + 1e-9
                    gain = np.where(better, value, gain)
                    where[better] = np.stack((np.full(nodes, j), best), axis=1)[better]
                for v in range(nodes):
                    if gain[v] > 0:
                        f[first + v] = where[v, 0]
                        t[first + v] = cuts[where[v, 0]][where[v, 1]]
                at = 2 * at + 1 + (x[np.arange(len(y)), f[at]] > t[at])
            spots = at - inner
            num = np.bincount(spots, weights=g, minlength=inner + 1)
            den = np.bincount(spots, weights=h, minlength=inner + 1)
            values = -rate * num / (den + penalty)
            scores[:, c] += values[spots]
            feature.append(f)
            cut.append(t)
            leaf.append(values)
    return Forest(np.array(feature), np.array(cut), np.array(leaf), classes, start)
