"""Places along a Hilbert curve, in numpy, for points of any dimension."""

from __future__ import annotations

import numpy as np

#: A place fits a non-negative long.
PLACE_BITS = 62


def places(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each row of `cells` (n, dim), whole numbers below 2**bits, on the curve.

    Points that are close on the curve are close in space. By axis transformation: bit by bit
    from the top, the lower bits of the first axis are flipped or exchanged with those of the
    axis at hand; then the axes are Gray-decoded and their bits interleaved.
    """
    x = cells.astype(np.int64).T.copy()
    dim = len(x)
    if dim * bits > PLACE_BITS:
        raise ValueError("too many bits for a place")
    bit = 1 << bits - 1 if bits else 0
    while bit > 1:
        low = bit - 1
        for axis in range(dim):
            on = (x[axis] & bit) != 0
            swap = np.where(on, 0, (x[0] ^ x[axis]) & low)
            x[0] ^= np.where(on, low, swap)
            x[axis] ^= swap
        bit >>= 1
    for axis in range(1, dim):
        x[axis] ^= x[axis - 1]
    gray, bit = np.zeros(x.shape[1], np.int64), 1 << bits - 1 if bits else 0
    while bit > 1:
        gray ^= np.where(x[-1] & bit, bit - 1, 0)
        bit >>= 1
    x ^= gray
    out = np.zeros(x.shape[1], np.int64)
    for level in range(bits - 1, -1, -1):
        for axis in range(dim):
            out = out << 1 | (x[axis] >> level & 1)
    return out
