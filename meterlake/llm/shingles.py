"""Word shingles as 64-bit numbers, in numpy."""

from __future__ import annotations

import numpy as np
from xxhash import xxh64_intdigest

_U = np.uint64


def constants(n: int, seed: int) -> np.ndarray:
    """``n`` odd 64-bit numbers from a seeded generator."""
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 1 << 64, n, dtype=_U, endpoint=False) | _U(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of each number over all of it (splitmix64's finish)."""
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxh64_intdigest, words), _U, len(words))


def window_hashes(h: np.ndarray, width: int, factors: np.ndarray) -> np.ndarray:
    """Hash of every run of ``width`` neighbours in ``h``."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, _U)
    out = h[:n] * factors[0]
    for j in range(1, width):
        out += h[j:j + n] * factors[j]
    return mix(out)
