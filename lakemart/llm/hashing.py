"""Vectorised hashes of byte strings, the same in every process.

A text gets prefix sums of byte values times powers of an odd number, modulo
2^64; the hash of any part of it is then one subtraction and one product.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
BASES = (_U(0x9E3779B97F4A7C15), _U(0xD6E8FEB86659FD93))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * _U(0x2545F4914F6CDD1D))
_powers: dict[int, np.ndarray] = {}


def _power(base: int, count: int) -> np.ndarray:
    """base^0 ... base^(count-1) modulo 2^64."""
    known = _powers.get(base)
    if known is None or len(known) < count:
        size = 1 << max(12, (count - 1).bit_length())
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        known = _powers[base] = np.multiply.accumulate(steps)
    return known[:count]


class Prefix:
    """Hashes of parts of one byte string."""

    def __init__(self, raw: np.ndarray, which: int = 0):
        base = int(BASES[which])
        self.inverse = pow(base, -1, 1 << 64)
        self.sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_BYTES[raw] * _power(base, len(raw)), out=self.sums[1:])

    def every(self, size: int) -> np.ndarray:
        """Hashes of all parts of `size` bytes, not mixed."""
        count = len(self.sums) - size
        return (self.sums[size:] - self.sums[:-size]) * _power(self.inverse, count)

    def parts(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of raw[start:end], not mixed."""
        if not len(start):
            return np.zeros(0, np.uint64)
        return (self.sums[end] - self.sums[start]) * _power(self.inverse, int(start.max()) + 1)[start]


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
