"""Hashes of the words of many texts at a time, over arrays of characters."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

#: Odd 64-bit multipliers (arbitrary fixed values).
K1, K2, K3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
_LONGEST = 1 << 16


@lru_cache(maxsize=4)
def _is_word(extra: str) -> np.ndarray:
    table = np.zeros(0x110000, dtype=bool)
    for cp in range(0x110000):
        if chr(cp).isalnum():
            table[cp] = True
    for c in extra:
        table[ord(c)] = True
    return table


@lru_cache(maxsize=1)
def _powers() -> np.ndarray:
    p = np.ones(_LONGEST, dtype=np.uint64)
    p[1:] = K1
    return np.multiply.accumulate(p)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64 bits."""
    x = (x ^ (x >> np.uint64(32))) * K2
    x = (x ^ (x >> np.uint64(29))) * K3
    return x ^ (x >> np.uint64(32))


def codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(code points of all texts, a line break after each; where each text begins, and the end)."""
    joined = "\n".join(texts) + "\n"
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    starts = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum(np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts)), out=starts[1:])
    return code, starts


def word_hashes(texts: list[str], extra: str = "") -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each word; its start; its end in ``codes``; offsets of the texts among the words).

    Words are runs of letters and digits, and of the characters of ``extra``.
    """
    code, starts = codes(texts)
    is_word = _is_word(extra)[code]
    first = is_word.copy()
    first[1:] &= ~is_word[:-1]
    last = is_word.copy()
    last[:-1] &= ~is_word[1:]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    bounds = np.searchsorted(begin, starts)
    if not len(begin):
        return np.zeros(0, dtype=np.uint64), begin, end, bounds
    place = np.arange(len(code)) - np.repeat(begin, np.diff(np.append(begin, len(code)))) if begin[0] == 0 else None
    if place is None:
        place = np.zeros(len(code), dtype=np.int64)
        place[begin[0] :] = np.arange(begin[0], len(code)) - np.repeat(begin, np.diff(np.append(begin, len(code))))
    value = (code.astype(np.uint64) + np.uint64(1)) * _powers()[place % _LONGEST]
    value[~is_word] = 0
    return mix(np.add.reduceat(value, begin) + (end - begin).astype(np.uint64) * K3), begin, end, bounds


def shingle_hashes(word: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each run of k words of one text; index of its first word; offsets of the texts among the runs)."""
    n = np.maximum(np.diff(bounds) - k + 1, 0)
    offs = np.zeros(len(bounds), dtype=np.int64)
    np.cumsum(n, out=offs[1:])
    at = np.repeat(bounds[:-1] - offs[:-1], n) + np.arange(offs[-1])
    h = np.zeros(len(at), dtype=np.uint64)
    for j in range(k):
        h = h * K1 + word[at + j]
    return mix(h), at, offs


def seeds(n: int) -> np.ndarray:
    """n fixed seeds."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * K1)
