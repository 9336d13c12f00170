"""Gradient-boosted trees in numpy: fitted on binned features, flattened to node arrays for scoring."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Trees:
    """All trees in one set of arrays: node i tests feature[i] <= threshold[i]; a leaf points to itself."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    base: float
    depth: int

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Sum of leaf values of each row of x; every tree is walked by all rows at once."""
        rows = np.arange(len(x))
        total = np.full(len(x), self.base)
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                goes_left = x[rows, self.feature[node]] <= self.threshold[node]
                node = np.where(goes_left, self.left[node], self.right[node])
            total += self.value[node]
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x))) if len(x) else np.zeros(0)


def fit(
    x: np.ndarray,
    y: np.ndarray,
    monotone: dict[int, int] | None = None,
    weight: np.ndarray | None = None,
    rounds: int = 60,
    depth: int = 4,
    rate: float = 0.2,
    bins: int = 64,
    l2: float = 1.0,
    least: float = 2.0,
) -> Trees:
    """Fit trees for log loss of y (0 or 1). monotone: by feature, 1 if the score may only rise with it, -1 fall.

    A split on such a feature must order the two leaf values, and all leaves below keep to their side of the middle.
    Without rows, or with one class only, there is no split and every score is the (smoothed) share of ones.
    """
    monotone = monotone or {}
    weight = np.ones(len(y)) if weight is None else weight
    share = (float((y * weight).sum()) + 1) / (float(weight.sum()) + 2)
    base = float(np.log(share / (1 - share)))
    feature, threshold, left, right, value, roots = [], [], [], [], [], []

    def add() -> int:
        i = len(feature)
        feature.append(0)
        threshold.append(np.inf)
        left.append(i)
        right.append(i)
        value.append(0.0)
        return i

    if len(y):
        edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for c in x.T]
        binned = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T)])
        width = max(len(e) for e in edges) + 1
    margin = np.full(len(y), base)
    for _ in range(rounds if 0 < y.sum() < len(y) else 0):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = weight * (p - y), weight * np.maximum(p * (1 - p), 1e-6)
        root = add()
        roots.append(root)
        level = [(root, -np.inf, np.inf)]
        where = np.zeros(len(y), np.int64)
        leaf_of = np.full(len(y), root)
        for at_depth in range(depth + 1):
            m = len(level)
            active = where >= 0
            g_all = np.bincount(where[active], grad[active], m)
            h_all = np.bincount(where[active], hess[active], m)
            best = np.full(m, 1e-6)
            choice: list[tuple[int, int] | None] = [None] * m
            sides = np.zeros((m, 2))
            lows, highs = np.array([n[1] for n in level]), np.array([n[2] for n in level])
            for f in range(x.shape[1]) if at_depth < depth else ():
                if not len(edges[f]):
                    continue
                key = where[active] * width + binned[f][active]
                g = np.bincount(key, grad[active], m * width).reshape(m, width).cumsum(1)[:, :-1]
                h = np.bincount(key, hess[active], m * width).reshape(m, width).cumsum(1)[:, :-1]
                gr, hr = g_all[:, None] - g, h_all[:, None] - h
                wl = np.clip(-g / (h + l2), lows[:, None], highs[:, None])
                wr = np.clip(-gr / (hr + l2), lows[:, None], highs[:, None])
                gain = -(g * wl + 0.5 * (h + l2) * wl**2) - (gr * wr + 0.5 * (hr + l2) * wr**2)
                w0 = np.clip(-g_all / (h_all + l2), lows, highs)
                gain += (g_all * w0 + 0.5 * (h_all + l2) * w0**2)[:, None]
                gain[(h < least * 0.1) | (hr < least * 0.1)] = 0
                if monotone.get(f):
                    gain[(wr - wl) * monotone[f] < 0] = 0
                at = gain.argmax(1)
                top = gain[np.arange(m), at]
                for i in np.flatnonzero(top > best):
                    best[i], choice[i] = top[i], (f, int(at[i]))
                    sides[i] = wl[i, at[i]], wr[i, at[i]]
            following = []
            moved = np.full(len(y), -1)
            for i, (node, low, high) in enumerate(level):
                split = choice[i]
                if split is None or split[1] >= len(edges[split[0]]):
                    value[node] = rate * float(np.clip(-g_all[i] / (h_all[i] + l2), low, high))
                    leaf_of[where == i] = node
                    continue
                f, b = split
                feature[node], threshold[node] = f, float(edges[f][b])
                left[node], right[node] = add(), add()
                middle = float(sides[i].mean())
                sign = monotone.get(f, 0)
                bounds_l = (low, min(high, middle)) if sign > 0 else (max(low, middle), high) if sign < 0 else (low, high)
                bounds_r = (max(low, middle), high) if sign > 0 else (low, min(high, middle)) if sign < 0 else (low, high)
                mine = where == i
                goes_left = binned[f] <= b
                moved[mine & goes_left] = len(following)
                following.append((left[node], *bounds_l))
                moved[mine & ~goes_left] = len(following)
                following.append((right[node], *bounds_r))
            if not following:
                break
            level, where = following, moved
        margin += np.array(value)[leaf_of]
    arrays = (np.array(v) for v in (roots, feature, threshold, left, right, value))
    roots_, feature_, threshold_, left_, right_, value_ = arrays
    return Trees(roots_.astype(np.int64), feature_.astype(np.int64), threshold_, left_.astype(np.int64), right_.astype(np.int64), value_, base, depth)
