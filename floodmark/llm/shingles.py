"""Shingle sets and circulant MinHash signatures, computed with numpy inside tasks."""

from __future__ import annotations

from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import xxhash

#: Positions of the hashed universe; a power of two.
UNIVERSE = 1 << 22
_MASK = np.uint64(UNIVERSE - 1)
_ODD = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], dtype=np.uint64
)


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one mixing of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def hashes_of(words: Iterable[bytes], count: int) -> np.ndarray:
    """64-bit hashes of so many words."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=count)


def word_hashes(text: str | None) -> np.ndarray:
    """64-bit hashes of the words of a text, A-Z lower-cased; words are separated by ASCII white space."""
    found = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    return hashes_of(found, len(found))


def shingle_rows(words: np.ndarray, size: int = 5) -> np.ndarray:
    """One 64-bit hash per shingle, in order; fewer words than `size` make one shingle of all of them."""
    n = len(words)
    if n == 0:
        return words
    width = min(size, n)
    rows = np.zeros(n - width + 1, dtype=np.uint64)
    for k in range(width):
        rows += mix(words[k : n - width + 1 + k] * _ODD[k] + np.uint64(width))
    return mix(rows)


def shingle_set(text: str | None, size: int = 5) -> np.ndarray:
    return np.unique(shingle_rows(word_hashes(text), size))


@lru_cache(maxsize=4)
def permutation(seed: int, extra: int) -> np.ndarray:
    order = np.random.default_rng(seed).permutation(UNIVERSE).astype(np.uint32)
    return np.concatenate([order, order[:extra]])


def places(hashes: np.ndarray) -> np.ndarray:
    """The first permutation: a bijection of 64-bit hashes, cut to the universe."""
    return (mix(hashes * np.uint64(0xD1342543DE82EF95) + np.uint64(0x2545F4914F6CDD1D)) & _MASK).astype(np.int64)


def signature(hashes: np.ndarray, k: int, seed: int = 42) -> np.ndarray:
    """Circulant MinHash of a non-empty set: coordinate i is the minimum over its places of the second permutation
    shifted by i places round the circle."""
    order = permutation(seed, k)
    at = places(hashes)
    shift = np.arange(k)
    best = np.full(k, UNIVERSE, dtype=np.uint32)
    for i in range(0, len(at), 2048):
        np.minimum(best, order[at[i : i + 2048, None] + shift].min(axis=0), out=best)
    return best


def band_keys(signatures: np.ndarray, rows: int) -> np.ndarray:
    """(n, k) signatures to (n, k // rows) band keys of 64 bits; the number of the band is part of the key."""
    n, k = signatures.shape
    bands = k // rows
    parts = signatures[:, : bands * rows].astype(np.uint64).reshape(n, bands, rows)
    keys = np.arange(bands, dtype=np.uint64)[None, :] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1)
    keys = np.broadcast_to(keys, (n, bands)).copy()
    for r in range(rows):
        keys = mix(keys * np.uint64(31) + parts[:, :, r])
    return keys.view(np.int64)
