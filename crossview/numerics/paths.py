"""Trajectories: resampling, distances and averages."""

from __future__ import annotations

import numpy as np


def resample(path: np.ndarray, n: int) -> np.ndarray:
    """A path with n points, linear between its own, evenly by index."""
    path = np.asarray(path, float).reshape(-1, 2)
    at, to = np.linspace(0, 1, len(path)), np.linspace(0, 1, n)
    return np.stack([np.interp(to, at, path[:, k]) for k in (0, 1)], 1)


def average(paths: list[np.ndarray]) -> np.ndarray:
    """The mean of paths by index, all resampled to the longest."""
    n = max(len(p) for p in paths)
    return np.mean([resample(p, n) for p in paths], axis=0)


def overlap(times: np.ndarray, path: np.ndarray, start, end) -> np.ndarray:
    """The points from the first at or after ``start`` to the first at or after ``end``, that one included."""
    a, b = np.searchsorted(times, start), np.searchsorted(times, end)
    return np.asarray(path, float).reshape(-1, 2)[a : b + 1]


def distance(a: np.ndarray, b: np.ndarray, kind: str) -> float | None:
    """Directed Hausdorff distance from a to b, or the mean distance by index; None without points."""
    if not len(a) or not len(b):
        return None
    n = max(len(a), len(b))
    a, b = (p if len(p) == n else resample(p, n) for p in (np.asarray(a, float).reshape(-1, 2), np.asarray(b, float).reshape(-1, 2)))
    if kind == "pairwise":
        return float(np.linalg.norm(a - b, axis=1).mean())
    if kind != "Hausdorff":
        raise ValueError(f"unknown distance {kind}")
    return float(np.sqrt(((a[:, None, :] - b[None, :, :]) ** 2).sum(2)).min(1).max())


def directed(pa: np.ndarray, pb: np.ndarray, da: np.ndarray | None, db: np.ndarray | None, magnitude: float) -> float:
    """Distance of two points, longer by the share of a half turn between directions of enough length."""
    d = float(np.linalg.norm(np.asarray(pa) - np.asarray(pb)))
    if da is None or db is None:
        return d
    na, nb = np.linalg.norm(da), np.linalg.norm(db)
    if na <= magnitude or nb <= magnitude:
        return d
    return d * (1 + float(np.arccos(np.clip(np.dot(da, db) / (na * nb), -1, 1))) / np.pi)
