"""Rising integers in little more space than their differences need, searched in numpy."""

from __future__ import annotations

import numpy as np

U64 = np.uint64
WORD = U64(64)


def _in_word(words: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Place of the ``k``-th (from 0) one in each word, by halving."""
    place = np.zeros(len(words), U64)
    k = k.astype(np.int64)
    for width in (32, 16, 8, 4, 2, 1):
        low = (words >> place) & U64((1 << width) - 1)
        ones = np.bitwise_count(low).astype(np.int64)
        beyond = k >= ones
        k = np.where(beyond, k - ones, k)
        place = np.where(beyond, place + U64(width), place)
    return place


class EliasFano:
    """A view on a buffer that ``encode`` made; the buffer may be a mapped file.

    Each value is cut into high and low bits.  Low bits lie packed side by side.  High bits
    are written in unary, a one for each value behind as many zeros as its high part has.
    One 32-bit count for each 64 bits finds any one or zero.
    """

    HEAD = 4  # 64-bit integers: number of values, low bits, words, values' bytes

    def __init__(self, buffer, at: int = 0):
        self.n, self.low_bits, n_words, n_low = (
            int(x) for x in np.frombuffer(buffer, U64, self.HEAD, at)
        )
        at += 8 * self.HEAD
        self.high = np.frombuffer(buffer, U64, n_words, at)
        at += 8 * n_words
        self.zeros_before = np.frombuffer(buffer, np.uint32, n_words, at)
        at += 4 * n_words + 4 * (n_words % 2)
        self.low = np.frombuffer(buffer, np.uint8, n_low, at)
        self.end = at + n_low

    @staticmethod
    def encode(values: np.ndarray, universe: int) -> bytes:
        """``values`` rise, or stay, and are below ``universe``, which is 2 ** 64 at most."""
        values, n = values.astype(U64), len(values)
        low_bits = min(max(0, (universe // max(n, 1)).bit_length() - 1), 56)
        high = values >> U64(low_bits)
        top = int(high[-1]) if n else 0
        n_words = (n + top + 1) // 64 + 1
        bits = np.zeros(64 * n_words, np.uint8)
        bits[high.astype(np.int64) + np.arange(n)] = 1
        words = np.packbits(bits, bitorder="little").view(U64)
        zeros = 64 - np.bitwise_count(words).astype(np.int64)
        before = (np.cumsum(zeros) - zeros).astype(np.uint32)
        if low_bits and n:
            places = np.arange(low_bits, dtype=U64)
            low = ((values[:, None] >> places) & U64(1)).astype(np.uint8)
            low = np.packbits(low.ravel(), bitorder="little").tobytes()
        else:
            low = b""
        low += bytes(16 - len(low) % 8)
        head = np.array([n, low_bits, n_words, len(low)], U64)
        return b"".join(
            [head.tobytes(), words.tobytes(), before.tobytes(), bytes(4 * (n_words % 2)), low]
        )

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), U64)
        bit = i.astype(np.int64) * self.low_bits
        byte, shift = bit >> 3, (bit & 7).astype(U64)
        found = np.zeros(len(i), U64)
        for k in range((self.low_bits + 14) // 8):
            part = self.low[byte + k].astype(U64)
            if k < 8:
                found |= (part << U64(8 * k)) >> shift
            if k == 7:
                found &= U64((1 << 56) - 1)
        return found & U64((1 << self.low_bits) - 1)

    def get(self, i: np.ndarray) -> np.ndarray:
        """The values at places ``i``."""
        ones_before = np.arange(len(self.high)) * 64 - self.zeros_before.astype(np.int64)
        word = np.searchsorted(ones_before, i, "right") - 1
        place = _in_word(self.high[word], i - ones_before[word]).astype(np.int64) + 64 * word
        return ((place - i).astype(U64) << U64(self.low_bits)) | self._low(i)

    def _first_of(self, high: np.ndarray) -> np.ndarray:
        """How many values have a smaller high part."""
        zero = high.astype(np.int64) - 1
        first = np.zeros(len(high), np.int64)
        total = int(self.zeros_before[-1]) + 64 - int(np.bitwise_count(self.high[-1]))
        within = (zero >= 0) & (zero < total)
        z = zero[within]
        word = np.searchsorted(self.zeros_before, z, "right") - 1
        place = _in_word(~self.high[word], z - self.zeros_before[word])
        first[within] = place.astype(np.int64) + 64 * word - z
        first[zero >= total] = self.n
        return np.minimum(first, self.n)

    def successor(self, x: np.ndarray) -> np.ndarray:
        """The place of the first value that is not below ``x``; ``n`` if there is none."""
        x = x.astype(U64)
        high = x >> U64(self.low_bits)
        low = x & U64((1 << self.low_bits) - 1)
        left, right = self._first_of(high), self._first_of(high + U64(1))
        right = np.where(high == U64((1 << 64) - 1 >> self.low_bits), self.n, right)
        while len(open_ := np.flatnonzero(left < right)):
            middle = (left[open_] + right[open_]) >> 1
            below = self._low(middle) < low[open_]
            left[open_] = np.where(below, middle + 1, left[open_])
            right[open_] = np.where(below, right[open_], middle)
        return left

    def find(self, x: np.ndarray) -> np.ndarray:
        """The place of ``x``, the first one if it repeats, or -1."""
        if not self.n:
            return np.full(len(x), -1, np.int64)
        at = self.successor(x)
        there = at < self.n
        there[there] = self.get(at[there]) == x[there].astype(U64)
        return np.where(there, at, -1)
