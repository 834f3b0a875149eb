"""The perfect Golay code of 23 bits: every word is within three bits of one codeword."""

from __future__ import annotations

import functools
from itertools import combinations

import numpy as np

BITS = 23
# Fixed value: generator polynomial x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GENERATOR = 0xC75


def _remainder(word: int) -> int:
    for bit in range(BITS - 1, 10, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - 11)
    return word


@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the lower 12 and the upper 11 bits, and the error of each syndrome."""
    low = np.array([_remainder(w) for w in range(1 << 12)], dtype=np.int32)
    high = np.array([_remainder(w << 12) for w in range(1 << 11)], dtype=np.int32)
    errors = np.zeros(1 << 11, dtype=np.int32)
    for weight in (1, 2, 3):
        for bits in combinations(range(BITS), weight):
            error = sum(1 << b for b in bits)
            errors[_remainder(error)] = error
    return low, high, errors


def nearest(words: np.ndarray) -> np.ndarray:
    """Index, 0 to 4095, of the codeword within three bits of each word."""
    low, high, errors = _tables()
    words = words.astype(np.int32)
    return (words ^ errors[low[words & 0xFFF] ^ high[words >> 12]]) >> 11


def nearby(words: np.ndarray) -> np.ndarray:
    """Codewords nearest to each word and to its 23 neighbours, as columns; six at most
    differ. If y is within one bit of x, nearest(y) is among nearby(x)."""
    flips = [0] + [1 << b for b in range(BITS)]
    return np.stack([nearest(words ^ flip) for flip in flips], axis=1)
