"""Vectorised hashing of words and runs of words."""

from __future__ import annotations

import numpy as np
import xxhash

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hash of each word."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; a bijection."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def run_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of `length` consecutive words; empty if there are fewer."""
    count = len(words) - length + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(count, np.uint64)
    if length <= 16:
        for j in range(length):
            total = total * MULTIPLIER + words[j: j + count]
        return mix(total)
    size, runs = 1, words  # runs of 1, 2, 4, ... words; the binary digits of `length` put them together
    offset, rest = 0, length
    while rest:
        if rest & 1:
            total = total * _power(size) + runs[offset: offset + count]
            offset += size
        rest >>= 1
        if rest:
            runs = runs[: len(runs) - size] * _power(size) + runs[size:]
            size *= 2
    return mix(total)


def _power(n: int) -> np.uint64:
    return np.uint64(pow(int(MULTIPLIER), n, 1 << 64))
