"""Word shingles of a text as sets of 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, k: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the ``k``-word shingles (A-Z lower-cased, words split at
    ASCII white space); fewer words give one shingle, none the empty set."""
    words = text.encode().translate(_LOWER).split() if text else []
    if not words:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    n = max(1, len(words) - k + 1)
    out = np.full(n, min(len(words), k), dtype=np.uint64)
    for j in range(min(k, len(words))):
        out = mixed(out * _STEP + h[j:j + n])
    return np.unique(out)
