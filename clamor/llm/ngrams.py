"""Hashed character n-grams of a batch of strings, as whole-array steps."""

from __future__ import annotations

import numpy as np

_MIX = np.uint64(0x9E3779B97F4A7C15)


def hashed(codes: np.ndarray, n: int, bits: int) -> np.ndarray:
    """The hash of codes[i:i + n] for each i, below 2 ** bits."""
    if len(codes) < n:
        return np.empty(0, np.int64)
    mixed = np.full(len(codes) - n + 1, n, np.uint64)
    for k in range(n):
        mixed += codes[k : len(codes) - n + 1 + k].astype(np.uint64)
        mixed *= _MIX
        mixed ^= mixed >> np.uint64(29)
    return (mixed >> np.uint64(64 - bits)).astype(np.int64)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


class DistinctPlaces:
    """Which hashed n-grams occur in a text, each once.

    Long texts are read in slices that overlap by the longest n-gram less one.
    """

    SLICE = 1 << 20

    def __init__(self, sizes: tuple[int, ...], bits: int):
        self.sizes, self.bits = sizes, bits
        self.last = np.zeros(1 << bits, np.int64)

    def of_slice(self, codes: np.ndarray) -> np.ndarray:
        places = np.concatenate([hashed(codes, n, self.bits) for n in self.sizes])
        # Each place remembers the last n-gram that wrote to it; that one speaks for it.
        turn = np.arange(len(places))
        self.last[places] = turn
        return places[self.last[places] == turn]

    def of(self, text: str) -> np.ndarray:
        text = text.lower()
        if len(text) <= self.SLICE:
            return self.of_slice(code_points(text))
        seen, overlap = np.zeros(1 << self.bits, bool), max(self.sizes) - 1
        for k in range(0, len(text), self.SLICE):
            seen[self.of_slice(code_points(text[k : k + self.SLICE + overlap]))] = True
        return np.flatnonzero(seen)
