"""Words, shingles and minima of one text; small helpers that run inside tasks on Arrow batches.

Words are runs of bytes other than ASCII white space, with A-Z lower-cased; ``bytes.lower`` and
``bytes.split`` do exactly that.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from xxhash import xxh3_64_intdigest

_STEP = np.uint64(0x9E3779B97F4A7C15)


def as_bytes(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a text column; null as empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def word_hashes(text: bytes) -> np.ndarray:
    words = text.lower().split()
    return np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return x ^ (x >> np.uint64(32))


def shingle_run(text: bytes, n: int) -> np.ndarray:
    """A 64-bit hash for each run of ``n`` words in order; with fewer words one for the whole, without words none."""
    words = word_hashes(text)
    if not len(words):
        return words
    k = min(n, len(words))
    out = np.full(len(words) - k + 1, k, np.uint64)
    for j in range(k):
        out = mixed(out * _STEP + words[j:len(words) - k + 1 + j])
    return out


def shingle_set(text: bytes, n: int) -> np.ndarray:
    return np.unique(shingle_run(text, n))


def permutations(count: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a, rng.integers(0, 1 << 63, count, dtype=np.uint64)


def minima(shingles: np.ndarray, a: np.ndarray, b: np.ndarray, step: int = 2048) -> np.ndarray:
    """The smallest value of each of the functions ``a * x + b`` over a non-empty set."""
    best = None
    for at in range(0, len(shingles), step):
        part = (a[:, None] * shingles[None, at:at + step] + b[:, None]).min(axis=1)
        best = part if best is None else np.minimum(best, part)
    return best


def shared(left: np.ndarray, right: np.ndarray) -> int:
    """Number of common members of two sorted sets."""
    if len(left) > len(right):
        left, right = right, left
    if not len(left):
        return 0
    at = np.minimum(np.searchsorted(right, left), len(right) - 1)
    return int((right[at] == left).sum())
