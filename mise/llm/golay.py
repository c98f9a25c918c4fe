"""The binary Golay code (23, 12, 7) on numpy arrays of 23-bit words."""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np

LENGTH, CHECKS = 23, 11
#: Generator polynomial x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GENERATOR = 0b101011100011


def _remainder(word: int) -> int:
    for shift in range(LENGTH - 1, CHECKS - 1, -1):
        if word >> shift & 1:
            word ^= GENERATOR << (shift - CHECKS)
    return word


@cache
def tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the high and the low 12 bits, and the error that each
    syndrome stands for (the code is perfect: every one within three bits)."""
    unit = [_remainder(1 << i) for i in range(LENGTH)]
    low = np.zeros(1 << 12, np.int32)
    high = np.zeros(1 << 11, np.int32)
    for i in range(12):
        low[np.arange(1 << 12) >> i & 1 == 1] ^= unit[i]
    for i in range(11):
        high[np.arange(1 << 11) >> i & 1 == 1] ^= unit[12 + i]
    error = np.zeros(1 << CHECKS, np.int32)
    for weight in range(1, 4):
        for bits in combinations(range(LENGTH), weight):
            syndrome = 0
            for b in bits:
                syndrome ^= unit[b]
            error[syndrome] = sum(1 << b for b in bits)
    return high, low, error


def codeword_index(words: np.ndarray) -> np.ndarray:
    """The 12 information bits of the codeword nearest to each word."""
    high, low, error = tables()
    syndrome = high[words >> 12] ^ low[words & 0xFFF]
    return (words ^ error[syndrome]) >> CHECKS


def nearby_indices(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, index) of every codeword that a word or one of its 23 neighbours
    decodes to.  Words up to two bits apart have a neighbour in common and so
    an index in common."""
    flips = np.concatenate([[0], 1 << np.arange(LENGTH)]).astype(np.int32)
    found = np.sort(codeword_index(words[:, None] ^ flips), axis=1)
    first = np.ones(found.shape, bool)
    first[:, 1:] = found[:, 1:] != found[:, :-1]
    row, _ = np.nonzero(first)
    return row, found[first]
