"""Word shingles of whole texts as hashes, in numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

MIX_A, MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
STEP = np.uint64(0x9E3779B97F4A7C15)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose every output bit depends on every input bit."""
    h = (h ^ (h >> np.uint64(30))) * MIX_A
    h = (h ^ (h >> np.uint64(27))) * MIX_B
    return h ^ (h >> np.uint64(31))


def word_hashes(text: str | None) -> np.ndarray:
    """Hashes of the words between white space, A-Z lower-cased; of bytes, both touch ASCII only."""
    words = (text or "").encode().lower().split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def shingle_hashes(words: np.ndarray, width: int = 5) -> np.ndarray:
    """One hash for each window of ``width`` words, in order; fewer words are one window."""
    if not len(words):
        return words
    n = max(1, len(words) - width + 1)
    h = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(min(width, len(words))):
            h = h * STEP + words[k : k + n]
        return mixed(h + np.uint64(min(width, len(words))))


def packed(values: np.ndarray) -> bytes:
    """Unsigned 32-bit integers, compressed."""
    return pa.compress(values.astype(np.uint32).tobytes(), "zstd", asbytes=True)


def unpacked(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, 4 * n, "zstd", asbytes=True), np.uint32)
