"""Words and word shingles as 64-bit hashes, in NumPy.

A word is a maximal run of bytes other than space and \\t\\n\\v\\f\\r; A-Z count as
a-z. Those are the rules of ``bytes.split`` and ``bytes.lower``.
"""

from __future__ import annotations

import numpy as np
import xxhash

from .store import kept

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def words(text: str | None) -> list[bytes]:
    """Lower-cased words of a text; none for null."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit over all output bits."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class WordHashes:
    """Hashes words, remembering at most ``limit`` of them (natural text repeats a few words very often)."""

    def __init__(self, limit: int = 150_000):
        self.limit, self.known = limit, {}

    def __call__(self, ws: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > self.limit:
            known.clear()
        for w in set(ws).difference(known):
            known[w] = xxhash.xxh64_intdigest(w)
        return np.fromiter(map(known.__getitem__, ws), dtype=np.uint64, count=len(ws))


def word_hashes() -> WordHashes:
    """The worker process's own hashes, which its tasks share."""
    return kept("words", WordHashes)


def rolling(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the ``k``-word shingles of a text with word hashes ``h``, in their order."""
    n = max(0, len(h) - k + 1)
    acc = np.full(n, np.uint64(k))
    for j in range(k):
        acc = mix(acc + _STEP + h[j : j + n])
    return acc


def shingle_hashes(h: np.ndarray, k: int, whole: bool = True) -> np.ndarray:
    """Sorted distinct hashes of the ``k``-word shingles of a text with word hashes ``h``.

    A text with fewer words is one shingle of all its words if ``whole``, else it
    has none; without words there is none either way.
    """
    if len(h) < k:
        if not whole or not len(h):
            return np.empty(0, np.uint64)
        k = len(h)
    return np.unique(rolling(h, k))
