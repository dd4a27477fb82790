"""Vectorised 64-bit hashes of words and of runs of values (numpy, inside tasks).

A run's hash is a difference of prefix sums: values are mixed, weighted by
powers of an odd base modulo 2**64, summed up once, and any run follows from two
entries and the inverse power at its start.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
#: Odd base of the polynomial and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> _U(33))
        x = x * _U(0xFF51AFD7ED558CCD)
        x = x ^ (x >> _U(33))
        x = x * _U(0xC4CEB9FE1A85EC53)
        return x ^ (x >> _U(33))


def byte_values(seed: int = 0) -> np.ndarray:
    """A random 64-bit value for each byte."""
    return mix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15) + _U(seed * 7919 + 1))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, grown by doubling."""
    out = np.ones(max(n, 1), _U)
    have, factor = 1, base % (1 << 64)
    with np.errstate(over="ignore"):
        while have < n:
            more = min(have, n - have)
            out[have:have + more] = out[:more] * _U(factor)
            factor = factor * factor % (1 << 64)
            have += more
    return out


class Runs:
    """Hashes of runs of ``values`` (uint64)."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        self.prefix = np.zeros(n + 1, _U)
        with np.errstate(over="ignore"):
            np.cumsum(values * powers(BASE, n), out=self.prefix[1:])
        self.back = powers(INVERSE, n + 1)

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Mixed hash of values[start:end] and of its length."""
        with np.errstate(over="ignore"):
            raw = (self.prefix[end] - self.prefix[start]) * self.back[start]
            return mix(raw + (end - start).astype(_U) * _U(0xD6E8FEB86659FD93))
