"""Gradient-boosted decision trees with logistic loss, and Platt calibration, for small training sets."""

from __future__ import annotations

import numpy as np


class BoostedTrees:
    """Trees of a fixed depth on features of small integers; each node holds the best split by gain."""

    def __init__(self, trees: int = 60, depth: int = 3, rate: float = 0.25, l2: float = 1.0):
        self.trees, self.depth, self.rate, self.l2 = trees, depth, rate, l2
        self.nodes: list[list[tuple[int, float, float]]] = []  # by tree, in heap order: (feature or -1, threshold, value)
        self.slope, self.shift = 1.0, 0.0
        self.thresholds: dict[int, float] = {}

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        score = np.zeros(len(y))
        cuts = [np.unique(c)[:-1] if len(np.unique(c)) <= 16 else np.unique(np.quantile(c, np.arange(1, 16) / 16)) for c in x.T]
        for _ in range(self.trees):
            p = 1 / (1 + np.exp(-score))
            tree, step = self._grow(x, y - p, p * (1 - p) + 1e-12, cuts)
            self.nodes.append(tree)
            score += self.rate * step
        return self

    def _grow(self, x: np.ndarray, g: np.ndarray, h: np.ndarray, cuts: list[np.ndarray]) -> tuple[list, np.ndarray]:
        at, out = np.zeros(len(x), np.int64), np.zeros(len(x))
        tree = [(-1, 0.0, 0.0)] * (2 ** (self.depth + 1) - 1)
        for node in range(len(tree)):
            rows = np.flatnonzero(at == node)
            if not len(rows):
                continue
            gs, hs = g[rows].sum(), h[rows].sum()
            value = gs / (hs + self.l2)
            best = (1e-6, -1, 0.0)
            if node < 2**self.depth - 1:
                for f, thresholds in enumerate(cuts):
                    left = x[rows, f][None, :] <= thresholds[:, None]
                    gl, hl = left @ g[rows], left @ h[rows]
                    gain = gl**2 / (hl + self.l2) + (gs - gl) ** 2 / (hs - hl + self.l2) - gs**2 / (hs + self.l2)
                    if len(gain) and gain.max() > best[0]:
                        best = (gain.max(), f, float(thresholds[gain.argmax()]))
            tree[node] = (best[1], best[2], value)
            if best[1] < 0:
                out[rows] = value
            else:
                at[rows] = 2 * node + 2 - (x[rows, best[1]] <= best[2])
        return tree, out

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        for tree in self.nodes:
            f, t, v = (np.array(c) for c in zip(*tree, strict=True))
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                inner = f[at] >= 0
                down = 2 * at + 2 - (x[np.arange(len(x)), np.maximum(f[at], 0)] <= t[at])
                at = np.where(inner, down, at)
            total += self.rate * v[at]
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * self.score(x) + self.shift)))

    def calibrate(self, x: np.ndarray, y: np.ndarray, precision: float, kinds: np.ndarray | None = None) -> BoostedTrees:
        """Platt scaling on rows that training didn't see. Then for each kind (all rows are of one if none are given) the threshold:
        of those from which the precision of its rows is at least as asked, the one that finds most, and of equals the most precise;
        it lies in the middle between the last row taken and the next, by score. Above 1 if no threshold is precise enough."""
        s, (a, b) = self.score(x), (1.0, 0.0)
        for _ in range(50):
            p = 1 / (1 + np.exp(-(a * s + b)))
            w = p * (1 - p) + 1e-9
            grad = np.array([((p - y) * s).sum() + 1e-3 * a, (p - y).sum()])
            hess = np.array([[(w * s * s).sum() + 1e-3, (w * s).sum()], [(w * s).sum(), w.sum() + 1e-6]])
            step = np.linalg.solve(hess, grad)
            a, b = a - step[0], b - step[1]
            if abs(step).max() < 1e-8:
                break
        self.slope, self.shift = float(a), float(b)
        p = self.probability(x)
        kinds = np.zeros(len(y), int) if kinds is None else kinds
        self.thresholds = {}
        for kind in np.unique(kinds):
            order = np.flatnonzero(kinds == kind)
            order = order[np.lexsort((y[order], -p[order]))]  # of equal probabilities the wrong ones first
            right = np.cumsum(y[order]) / np.arange(1, len(order) + 1)
            last_of_equals = np.append(p[order][1:] < p[order][:-1], True)
            good = np.flatnonzero((right >= precision) & last_of_equals)
            if not len(good):
                self.thresholds[int(kind)] = 2.0
                continue
            k = good[np.argmax(np.cumsum(y[order])[good])]
            ends = np.clip(p[order[k : k + 2]], 1e-6, 1 - 1e-6)
            self.thresholds[int(kind)] = float(1 / (1 + np.exp(-np.log(ends / (1 - ends)).mean())))
        return self
