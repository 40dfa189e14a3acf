"""Vectors of a block as NumPy rows, and their distances."""

from __future__ import annotations

import numpy as np
import pandas as pd

TILE_ROWS = 500
NARROW = 8
#: Distances that a tile holds at a time, so that they stay in the processor's cache.
TILE_CELLS = 1 << 18


def distances(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Euclidean distances of every left row to every right row."""
    if left.shape[1] <= NARROW:
        squared = np.zeros((len(left), len(right)))
        for i in range(left.shape[1]):
            squared += (left[:, i, None] - right[None, :, i]) ** 2
        return np.sqrt(squared)
    centre = left.mean(axis=0)
    a, b = left - centre, right - centre
    squared = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2.0 * (a @ b.T)
    return np.sqrt(np.maximum(squared, 0.0))


def _whole(left: np.ndarray, right: np.ndarray):
    """The number type in which products of these whole numbers are exact; None where one is not whole or too large."""
    top = max(np.abs(left).max(initial=0.0), np.abs(right).max(initial=0.0))
    reach = 4.0 * top * top * max(1, left.shape[1])
    if not reach < 2.0**52 or (np.rint(left) != left).any() or (np.rint(right) != right).any():
        return None
    return np.float32 if reach < 2.0**24 else np.float64


def exact_products(left: np.ndarray, right: np.ndarray) -> bool:
    """Whether :func:`distance_tiles` are exact here, as for whole numbers."""
    return _whole(left, right) is not None


def _squares(left: np.ndarray, right: np.ndarray, kind):
    """Tiles with their squared distances from one product: of the vectors, their squares and ones."""
    centre = 0.0 if kind else left.mean(axis=0)
    a, b = ((x - centre).astype(kind or float) for x in (left, right))
    one = lambda x: np.ones((len(x), 1), x.dtype)
    power = lambda x: (x * x).sum(axis=1)[:, None]
    a, b = np.hstack([-2 * a, power(a), one(a)]), np.ascontiguousarray(np.hstack([b, one(b), power(b)]).T)
    step = max(16, TILE_CELLS // max(1, len(right)))
    for start in range(0, len(a), step):
        part = slice(start, start + step)
        yield part, a[part] @ b


def distance_tiles(left: np.ndarray, right: np.ndarray):
    """Slices of the left rows with their distances to every right row; those of whole numbers are exact."""
    kind = _whole(left, right)
    if kind is None and left.shape[1] <= NARROW:
        step = max(16, TILE_CELLS // max(1, len(right)))
        for start in range(0, len(left), step):
            part = slice(start, start + step)
            yield part, distances(left[part], right)
        return
    for part, squared in _squares(left, right, kind):
        squared = np.maximum(squared, 0.0).astype(float, copy=False)
        yield part, np.sqrt(squared, out=squared)


def within_tiles(left: np.ndarray, right: np.ndarray, reach: float):
    """Slices of the left rows, and which pairs lie within reach.

    Squares of whole numbers are compared as they are; otherwise pairs close to the limit are measured again term by term.
    """
    kind = _whole(left, right)
    if kind is None or not 0.0 <= reach < 2.0**25:
        slack = 1e-7 * (1.0 + reach + np.abs(left).max(initial=0.0) + np.abs(right).max(initial=0.0))
        for part, d in distance_tiles(left, right):
            if kind is None and left.shape[1] > NARROW:
                i, j = np.nonzero(np.abs(d - reach) <= slack)
                d[i, j] = measured_pairs(left[part], right, i, j)
            yield part, d <= reach
        return
    most = int(reach * reach) + 1
    while most > 0 and np.sqrt(float(most)) > reach:
        most -= 1
    for part, squared in _squares(left, right, kind):
        yield part, squared <= most + 0.5


def measured_pairs(left: np.ndarray, right: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Distances of pairs term by term, a few megabytes at a time."""
    step = max(1, (1 << 19) // max(1, left.shape[1]))
    parts = [np.sqrt(((left[i[a : a + step]] - right[j[a : a + step]]) ** 2).sum(axis=1)) for a in range(0, len(i), step)]
    return np.concatenate(parts) if parts else np.zeros(0)


def matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=float) for v in vectors])


def tiles(vectors: np.ndarray):
    """Slices of the targets, so that a distance matrix stays small."""
    for start in range(0, len(vectors), TILE_ROWS):
        yield slice(start, start + TILE_ROWS)
