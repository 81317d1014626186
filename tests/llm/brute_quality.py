"""Minimum covariance determinant of one kind's rows in numpy, start by start."""

from __future__ import annotations

import math

import numpy as np

from linkrank.llm import quality as q


def least(values: np.ndarray, share: float) -> float:
    """The least value that such a share of them does not exceed."""
    whole = np.sort(np.round(values * 1000).astype(np.int64))
    return whole[math.ceil(share * len(whole)) - 1] / 1000


def distance(x: np.ndarray, centre: np.ndarray, scatter: np.ndarray) -> np.ndarray:
    off = x - centre
    return np.minimum(np.round(np.einsum("ni,ij,nj->n", off, np.linalg.inv(q.floored(scatter)), off), 3), q.FAR)


def moments(x: np.ndarray, share: float) -> tuple[np.ndarray, np.ndarray]:
    return x.mean(axis=0), q.consistency(share) * np.cov(x.T, bias=True)


def distances(x: np.ndarray) -> np.ndarray:
    centre = np.array([least(c, 0.5) for c in x.T])
    width = np.maximum(1.4826 * np.array([least(c, 0.5) for c in np.abs(x - centre).T]), q.FLOORS)
    unit = (x - centre) / width
    length = np.linalg.norm(unit, axis=1, keepdims=True)
    sign = np.divide(unit, length, out=np.zeros_like(unit), where=length > 0)
    begun = [
        (centre, np.diag(width**2)),
        (centre, 5 * (sign.T @ sign) / len(x) * np.outer(width, width)),
        moments(x, 1 - 1e-12),
    ]
    ended = []
    for centre, scatter in begun:
        for _ in range(q.STEPS):
            d = distance(x, centre, scatter)
            centre, scatter = moments(x[d <= least(d, q.KEPT_SHARE)], q.KEPT_SHARE)
        ended.append((np.linalg.slogdet(q.floored(scatter))[1], centre, scatter))
    _, centre, scatter = min(ended, key=lambda e: e[0])
    near = distance(x, centre, scatter) <= q.quantile(q.NEAR_SHARE)
    return distance(x, *moments(x[near], q.NEAR_SHARE))
