"""Hilbert curve index of integer grid points, vectorised over points.

Follows the published transpose form (J. Skilling, "Programming the Hilbert
curve", 2004): undo the rotations of each level, Gray-encode, interleave.
"""

from __future__ import annotations

import numpy as np


def hilbert_index(points: np.ndarray, bits: int) -> np.ndarray:
    """``points``: (n, d) integers in [0, 2**bits); d * bits at most 63.
    Returns one int64 curve index per point."""
    n, dims = points.shape
    if dims * bits > 63:
        raise ValueError("dims * bits must be at most 63")
    x = points.astype(np.int64).T.copy()
    for level in range(bits - 1, 0, -1):
        top, low = np.int64(1) << level, (np.int64(1) << level) - 1
        for i in range(dims):
            high = (x[i] & top) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            if i:
                x[i] ^= swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros(n, np.int64)
    for level in range(bits - 1, 0, -1):
        turn ^= np.where((x[dims - 1] >> level) & 1, (np.int64(1) << level) - 1, 0)
    x ^= turn
    index = np.zeros(n, np.int64)
    for level in range(bits - 1, -1, -1):
        for i in range(dims):
            index = (index << 1) | ((x[i] >> level) & 1)
    return index
