"""Words and shingles of texts as arrays of 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

# bytes.split() without arguments cuts exactly at \x20 and \x09-\x0D.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective scramble of 64-bit numbers; another one for each seed."""
    x = x + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def run_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` words, in text order (order-sensitive)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = mix(out * _A + words[j : j + n], k)
    return out


def shingles(text: str | None, k: int = 3) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``k`` lower-cased words; fewer
    words are one shingle, no words none."""
    words = text.encode().translate(LOWER).split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    hashes = word_hashes(words)
    return np.unique(run_hashes(hashes, k if len(words) >= k else len(words)))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
