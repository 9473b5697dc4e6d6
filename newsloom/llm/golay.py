"""The binary Golay code (23, 12), used backwards as a fuzzy hash.

The code is perfect: every 23-bit word lies within 3 bits of exactly one codeword, so decoding
maps a word to a 12-bit codeword index. ``near_indices`` gives the indices that the word and all
its one-bit neighbours decode to: one (words within 2 bits of their codeword) or six (the
others). Two words that differ in at most 2 bits have a common one-bit neighbour, or are
neighbours, so their index sets share a member.
"""

from __future__ import annotations

from functools import cache

import numpy as np

#: Fixed values of the code: length, message bits, and generator polynomial x^11+x^10+x^6+x^5+x^4+x^2+1.
LENGTH, MESSAGE, GENERATOR = 23, 12, 0xC75
CHECK = LENGTH - MESSAGE


def _remainder(word: int) -> int:
    for bit in range(LENGTH - 1, CHECK - 1, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - CHECK)
    return word


@cache
def tables() -> tuple[np.ndarray, np.ndarray]:
    """Check bits of every 12-bit message; error pattern of every 11-bit syndrome."""
    checks = np.array([_remainder(m << CHECK) for m in range(1 << MESSAGE)], dtype=np.int64)
    errors = np.zeros(1 << CHECK, dtype=np.int64)
    flips = [0] + [1 << i for i in range(LENGTH)]
    for a in flips:
        for b in flips:
            for c in flips:
                pattern = a | b | c
                errors[_remainder(pattern)] = pattern
    return checks, errors


def decode(words: np.ndarray) -> np.ndarray:
    """Index (0..4095) of the codeword nearest to each 23-bit word."""
    checks, errors = tables()
    words = words.astype(np.int64)
    syndrome = checks[words >> CHECK] ^ (words & ((1 << CHECK) - 1))
    return (words ^ errors[syndrome]) >> CHECK


def near_indices(words: np.ndarray) -> np.ndarray:
    """(n, 24) indices of each word and its one-bit neighbours, sorted; repeats are set to -1."""
    flips = np.array([0] + [1 << i for i in range(LENGTH)], dtype=np.int64)
    found = np.sort(decode((words.astype(np.int64)[:, None] ^ flips).ravel()).reshape(-1, len(flips)), axis=1)
    found[:, 1:][found[:, 1:] == found[:, :-1].copy()] = -1
    return found
