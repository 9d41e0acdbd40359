"""Places along a Hilbert curve for points with few coordinates (the transposed form published by J. Skilling)."""

from __future__ import annotations

import numpy as np


def hilbert_keys(points: np.ndarray, bits: int) -> np.ndarray:
    """Rows of unsigned coordinates below ``2**bits`` to their place on the curve; dimensions * bits is at most 62."""
    axes = [points[:, k].astype(np.int64) for k in range(points.shape[1])]
    side = 1 << (bits - 1)
    while side > 1:
        low = side - 1
        for k in range(len(axes)):
            hit = (axes[k] & side) != 0
            swap = np.where(hit, 0, (axes[0] ^ axes[k]) & low)
            axes[0] = np.where(hit, axes[0] ^ low, axes[0] ^ swap)
            axes[k] = axes[k] ^ swap if k else axes[0]
        side >>= 1
    for k in range(1, len(axes)):
        axes[k] = axes[k] ^ axes[k - 1]
    turn = np.zeros_like(axes[0])
    side = 1 << (bits - 1)
    while side > 1:
        turn ^= np.where(axes[-1] & side, side - 1, 0)
        side >>= 1
    key = np.zeros_like(axes[0])
    for bit in range(bits - 1, -1, -1):
        for axis in axes:
            key = (key << 1) | (((axis ^ turn) >> bit) & 1)
    return key
