"""Prefix polynomial hashes modulo 2**64 over numpy arrays, and sliding minima."""

from __future__ import annotations

import numpy as np

BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
MASK = (1 << 64) - 1


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread a hash's entropy over all its bits; one to one."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    return h ^ (h >> np.uint64(29))


class Powers:
    """Powers of the base and of its inverse, grown as needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def ensure(self, n: int) -> None:
        if n > len(self.up):
            size = max(n, 2 * len(self.up), 1 << 14)
            for name, base in (("up", BASE), ("down", INVERSE)):
                powers = np.full(size, base, dtype=np.uint64)
                powers[0] = 1
                setattr(self, name, np.multiply.accumulate(powers))

    def prefix(self, values: np.ndarray) -> np.ndarray:
        """Sums of (value + 1) * base**i over the first n values, n from 0 on."""
        n = len(values)
        self.ensure(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((values.astype(np.uint64) + np.uint64(1)) * self.up[:n], out=sums[1:])
        return sums

    def of(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of [start, end); equal contents have equal hashes wherever they stand."""
        return (sums[end] - sums[start]) * self.down[start]

    def grams(self, values: np.ndarray, k: int) -> np.ndarray:
        """Mixed hash of each k-gram; of the whole where it is shorter."""
        sums = self.prefix(values)
        k = min(k, len(values))
        return mixed((sums[k:] - sums[: len(sums) - k]) * self.down[: len(values) - k + 1])


def window_argmin(h: np.ndarray, window: int) -> np.ndarray:
    """Position of the least of each window of h, the rightmost of equal ones; of all of h if it is shorter.

    Hashes are compared by their upper 40 bits, and positions within a window
    of less than 2**24 by the lower 24.
    """
    n = len(h)
    window = min(window, n)
    low = np.uint64(0xFFFFFF)
    value = (h & ~low) | (low - (np.arange(n, dtype=np.uint64) & low))
    if n > 1 << 24:
        raise ValueError("longer arrays are to be cut by the caller")
    blocks = np.concatenate([value, np.full(-n % window, ~np.uint64(0))]).reshape(-1, window)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(right[: n - window + 1], left[window - 1 : n])
    return (low - (least & low)).astype(np.int64)


def minimizers(h: np.ndarray, window: int, step: int = 1 << 20) -> np.ndarray:
    """Ascending positions that are the minimum of some window; long arrays in overlapping parts."""
    n = len(h)
    found = []
    for at in range(0, max(1, n - window + 1), step):
        found.append(np.unique(window_argmin(h[at : at + step + window - 1], window)) + at)
    return found[0] if len(found) == 1 else np.unique(np.concatenate(found))
