"""Nearest points and cells of the E8 lattice."""

from __future__ import annotations

from itertools import combinations, product

import numpy as np

DIM = 8


def _shortest() -> np.ndarray:
    """The 240 shortest vectors: two entries of +-1, or all +-1/2 with an even number of minus signs."""
    whole = [[s if k == i else t if k == j else 0.0 for k in range(DIM)]
             for i, j in combinations(range(DIM), 2) for s, t in product((1.0, -1.0), repeat=2)]
    half = [v for v in product((0.5, -0.5), repeat=DIM) if sum(x < 0 for x in v) % 2 == 0]
    return np.array(whole + [list(v) for v in half])


SHORTEST = _shortest()


def _nearest_d8(x: np.ndarray) -> np.ndarray:
    """Nearest whole vectors with an even sum: round, and where the sum is odd round the worst entry the other way."""
    r = np.rint(x)
    off = x - r
    worst = np.argmax(np.abs(off), axis=-1)[..., None]
    other = np.take_along_axis(r, worst, -1) + np.where(np.take_along_axis(off, worst, -1) < 0, -1.0, 1.0)
    flipped = r.copy()
    np.put_along_axis(flipped, worst, other, -1)
    return np.where((r.sum(axis=-1, keepdims=True) % 2) != 0, flipped, r)


def nearest(x: np.ndarray) -> np.ndarray:
    """Nearest lattice points of the rows of ``x`` (..., 8): the better of D8 and D8 + 1/2."""
    a, b = _nearest_d8(x), _nearest_d8(x - 0.5) + 0.5
    nearer = ((x - a) ** 2).sum(-1, keepdims=True) <= ((x - b) ** 2).sum(-1, keepdims=True)
    return np.where(nearer, a, b)
