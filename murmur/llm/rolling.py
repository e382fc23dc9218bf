"""Polynomial fingerprints of runs, modulo 2^64, from prefix sums.

With P[i] the sum of x[j] * base^j over all j < i, the run from s to e has the fingerprint
(P[e] - P[s]) / base^s, the same wherever the run stands; an odd base has an inverse.
"""

from __future__ import annotations

import numpy as np

BASE = 0xA24BAED4963EE407
# The factors of the 64-bit finalizer of MurmurHash3.
FACTORS = np.array([0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53], np.uint64)


_known = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i for i < n at least; what is made is kept."""
    if len(_known[0]) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        for k, base in enumerate((BASE, pow(BASE, -1, 1 << 64))):
            made = np.ones(size, np.uint64)
            np.multiply.accumulate(np.full(size - 1, base, np.uint64), out=made[1:])
            _known[k] = made
    return _known[0], _known[1]


def prefixes(values: np.ndarray) -> np.ndarray:
    """P of ``values``, one longer than they are."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(len(values))[0][: len(values)], out=out[1:])
    return out


def runs(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The fingerprints of the runs from ``starts`` to ``ends``."""
    return (prefix[ends] - prefix[starts]) * powers(len(prefix))[1][starts]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits in which every bit counts for every other."""
    x = (x ^ x >> np.uint64(33)) * FACTORS[0]
    x = (x ^ x >> np.uint64(33)) * FACTORS[1]
    return x ^ x >> np.uint64(33)
