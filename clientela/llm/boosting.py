"""Gradient-boosted trees with monotonic constraints in numpy, and their flat form."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class BoostConfig:
    trees: int = 60
    depth: int = 4
    rate: float = 0.15
    bins: int = 64
    leaf_rows: float = 5.0
    ridge: float = 1.0


@dataclass(frozen=True)
class FlatTrees:
    """Nodes of all trees in arrays. A leaf points to itself on both sides."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int
    base: float

    def margin(self, rows: np.ndarray) -> np.ndarray:
        """Log odds of each row; all rows go down all trees one level at a time."""
        node = np.broadcast_to(self.roots, (len(rows), len(self.roots)))
        at = np.arange(len(rows))[:, None]
        for _ in range(self.depth):
            goes_left = rows[at, self.feature[node]] <= self.threshold[node]
            node = np.where(goes_left, self.left[node], self.right[node])
        return self.base + self.value[node].sum(1)

    def probability(self, rows: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.margin(rows), -50, 50)))


class _Grower:
    """One boosting run over binned rows."""

    def __init__(self, rows: np.ndarray, signs: np.ndarray, cfg: BoostConfig):
        self.cfg, self.signs = cfg, signs
        inner = np.linspace(0, 1, cfg.bins + 1)[1:-1]
        self.cuts = [np.unique(np.quantile(column, inner)) for column in rows.T]
        self.binned = np.stack(
            [np.searchsorted(cuts, column) for cuts, column in zip(self.cuts, rows.T, strict=True)]
        )
        self.nodes: list[list[float]] = []  # feature, threshold, left, right, value

    def _leaf(self, grad: float, hess: float, low: float, high: float) -> float:
        return float(np.clip(-grad / (hess + self.cfg.ridge), low, high))

    def _best(self, at, grad, hess, low, high):
        """Feature, bin and the values of both sides of the best allowed split."""
        cfg, best = self.cfg, None
        total_g, total_h = grad[at].sum(), hess[at].sum()
        floor = 1e-9

        def gain(g, h, w):
            return -(g * w + 0.5 * (h + cfg.ridge) * w * w)

        whole = self._leaf(total_g, total_h, low, high)
        base = gain(total_g, total_h, whole)
        for f, cuts in enumerate(self.cuts):
            if not len(cuts):
                continue
            bins, size = self.binned[f][at], len(cuts) + 1
            g = np.cumsum(np.bincount(bins, grad[at], size))[:-1]
            h = np.cumsum(np.bincount(bins, hess[at], size))[:-1]
            n = np.cumsum(np.bincount(bins, minlength=size))[:-1]
            left = np.clip(-g / (h + cfg.ridge), low, high)
            right = np.clip(-(total_g - g) / (total_h - h + cfg.ridge), low, high)
            gains = gain(g, h, left) + gain(total_g - g, total_h - h, right) - base
            allowed = (n >= cfg.leaf_rows) & (len(at) - n >= cfg.leaf_rows)
            if self.signs[f]:
                allowed &= self.signs[f] * (right - left) >= 0
            gains = np.where(allowed, gains, -np.inf)
            k = int(np.argmax(gains))
            if gains[k] > floor:
                floor, best = gains[k], (f, k, left[k], right[k])
        return best

    def grow(self, at, grad, hess, depth=0, low=-np.inf, high=np.inf) -> int:
        me = len(self.nodes)
        value = self._leaf(grad[at].sum(), hess[at].sum(), low, high)
        self.nodes.append([0, np.inf, me, me, value * self.cfg.rate])
        found = self._best(at, grad, hess, low, high) if depth < self.cfg.depth else None
        if found:
            f, k, left, right = found
            side = self.binned[f][at] <= k
            # All of one side stays beyond the middle, so the constraint holds below as well.
            middle = (left + right) / 2
            bounds = [(low, high), (low, high)]
            if self.signs[f] > 0:
                bounds = [(low, middle), (middle, high)]
            elif self.signs[f] < 0:
                bounds = [(middle, high), (low, middle)]
            a = self.grow(at[side], grad, hess, depth + 1, *bounds[0])
            b = self.grow(at[~side], grad, hess, depth + 1, *bounds[1])
            self.nodes[me] = [f, self.cuts[f][k], a, b, 0.0]
        return me


def fit(rows: np.ndarray, good: np.ndarray, signs: np.ndarray, cfg: BoostConfig) -> FlatTrees:
    """Logistic boosting. ``signs``: +1 rising, -1 falling, 0 free, for each feature."""
    share = np.clip(good.mean(), 1e-3, 1 - 1e-3) if len(good) else 0.5
    base = float(np.log(share / (1 - share)))
    margin = np.full(len(good), base)
    grower = _Grower(rows, signs, cfg)
    roots = []
    for _ in range(cfg.trees if len(good) else 0):
        p = 1 / (1 + np.exp(-margin))
        start = len(grower.nodes)
        roots.append(grower.grow(np.arange(len(good)), p - good, p * (1 - p)))
        made = _flat(grower.nodes, [start], cfg.depth, 0.0)
        margin += made.margin(rows)
    return _flat(grower.nodes, roots, cfg.depth, base)


def _flat(nodes: list, roots: list[int], depth: int, base: float) -> FlatTrees:
    table = np.array(nodes, np.float64).reshape(-1, 5)
    return FlatTrees(
        np.array(roots, np.int64), table[:, 0].astype(np.int64), table[:, 1],
        table[:, 2].astype(np.int64), table[:, 3].astype(np.int64), table[:, 4], depth, base,
    )
