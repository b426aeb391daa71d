"""Voting labelers combined by expectation-maximisation, and a logistic model
fitted to the result.

Both work on tables of distinct patterns with their counts, whose number is
bounded by the labelers' values, so plain Python on the driver is enough; the
counting over all data is Spark's.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass


def _sigmoid(z: float) -> float:
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


@dataclass
class LabelModel:
    """Class share and, per labeler, P(vote 1 | yes), P(vote 1 | no) among its
    votes; a vote of 0 abstains."""

    share: float
    hit: list[float]
    miss: list[float]

    def posterior(self, votes: Sequence[int]) -> float:
        z = math.log(self.share / (1 - self.share))
        for v, h, m in zip(votes, self.hit, self.miss, strict=True):
            if v:
                z += math.log(h / m) if v > 0 else math.log((1 - h) / (1 - m))
        return _sigmoid(z)


def estimate_reliabilities(patterns: Sequence[tuple[Sequence[int], float]], rounds: int = 50,
                           start_hit: float = 0.8, start_miss: float = 0.2) -> LabelModel:
    """EM over (votes, count) patterns of labelers that are independent given
    the class.  Starts from labelers better than chance, which fixes which
    class is yes; estimates are smoothed, and kept better than chance."""
    n = len(patterns[0][0]) if patterns else 0
    model = LabelModel(0.5, [start_hit] * n, [start_miss] * n)
    for _ in range(rounds if patterns else 0):
        yes = [(votes, count, model.posterior(votes)) for votes, count in patterns]
        total = sum(c for _, c, _ in yes)
        hit, miss = [], []
        for k in range(n):
            up = [sum(c * p for v, c, p in yes if v[k] > 0), sum(c * (1 - p) for v, c, p in yes if v[k] > 0)]
            cast = [sum(c * p for v, c, p in yes if v[k]), sum(c * (1 - p) for v, c, p in yes if v[k])]
            h, m = (up[0] + 4 * start_hit) / (cast[0] + 4), (up[1] + 4 * start_miss) / (cast[1] + 4)
            m = min(max(m, 0.01), 0.9)
            hit.append(min(max(h, m + 0.01), 0.99))
            miss.append(m)
        share = (sum(c * p for _, c, p in yes) + 1) / (total + 2)
        model = LabelModel(min(max(share, 0.01), 0.99), hit, miss)
    return model


def fit_logistic(rows: Sequence[tuple[Sequence[float], float, float]], steps: int = 300,
                 ridge: float = 1e-2) -> list[float]:
    """Weights, bias last, from (features, soft label, count) rows, by gradient
    descent with Adam on the mean log loss."""
    size = len(rows[0][0]) + 1 if rows else 1
    total = sum(c for _, _, c in rows) or 1.0
    w, m, v = [0.0] * size, [0.0] * size, [0.0] * size
    for step in range(1, steps + 1 if rows else 1):
        grad = [ridge * x for x in w[:-1]] + [0.0]
        for x, y, c in rows:
            d = c / total * (_sigmoid(w[-1] + sum(a * b for a, b in zip(w, x, strict=False))) - y)
            for k, value in enumerate(x):
                if value:
                    grad[k] += d * value
            grad[-1] += d
        for k in range(size):
            m[k] = 0.9 * m[k] + 0.1 * grad[k]
            v[k] = 0.999 * v[k] + 0.001 * grad[k] ** 2
            w[k] -= 0.1 * (m[k] / (1 - 0.9 ** step)) / (math.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-9)
    return w
