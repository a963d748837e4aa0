"""The binary Golay code [23, 12, 7] as a hash that tolerates errors.

Every 23-bit word lies within three errors of exactly one codeword. The
neighbour indices of a word are the codewords nearest to it and to the 23 words
at one error from it: two words at most two errors apart have a word between
them that is at most one error from both, hence an index in common.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np

BITS, MESSAGE = 23, 12
CHECK = BITS - MESSAGE
#: Generator polynomial x^11 + x^9 + x^7 + x^6 + x^5 + x + 1 (fixed value of the code).
GENERATOR = 0xAE3


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """(check bits of each message, error pattern of each syndrome), both by rule."""
    check = np.zeros(1 << MESSAGE, dtype=np.int32)
    for m in range(1 << MESSAGE):
        v = m << CHECK
        for i in range(BITS - 1, CHECK - 1, -1):
            if v >> i & 1:
                v ^= GENERATOR << (i - CHECK)
        check[m] = v
    error = np.zeros(1 << CHECK, dtype=np.int32)
    for weight in range(4):
        for places in combinations(range(BITS), weight):
            e = sum(1 << p for p in places)
            error[check[e >> CHECK] ^ (e & (1 << CHECK) - 1)] = e
    return check, error


def decode(word: np.ndarray) -> np.ndarray:
    """Message of the codeword nearest to each word."""
    check, error = _tables()
    word = word.astype(np.int32)
    return (word ^ error[check[word >> CHECK] ^ (word & (1 << CHECK) - 1)]) >> CHECK


def neighbour_indices(word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, index): each word's distinct neighbour indices, one to six of them."""
    found = np.stack([decode(word), *(decode(word ^ (1 << j)) for j in range(BITS))], axis=1)
    found.sort(axis=1)
    new = np.ones(found.shape, dtype=bool)
    new[:, 1:] = found[:, 1:] != found[:, :-1]
    row, column = np.nonzero(new)
    return row, found[row, column]
