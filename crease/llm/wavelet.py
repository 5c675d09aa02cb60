"""Wavelet matrix over a numpy array of small integers; every query is vectorised.

Level by level, from the highest bit down, the values are dealt stably by that bit (zeros
first); a running count of the zeros of each level turns an interval of one level into an
interval of the next. Memory: 4 bytes a value and bit.
"""

from __future__ import annotations

import numpy as np


class WaveletMatrix:
    def __init__(self, values: np.ndarray, bits: int):
        """``values`` are integers from 0 to 2**bits - 1."""
        self.size, self.bits = len(values), bits
        self.zeros: list[np.ndarray] = []  # zeros among the first i values of a level
        now = np.asarray(values)
        for b in range(bits - 1, -1, -1):
            one = (now >> b & 1).astype(bool)
            count = np.zeros(len(now) + 1, np.int32)
            np.cumsum(~one, out=count[1:])
            self.zeros.append(count)
            now = np.concatenate([now[~one], now[one]])

    def _down(self, level: int, at: np.ndarray, one: np.ndarray) -> np.ndarray:
        """The place on the next level of place ``at``, by the bit taken."""
        count = self.zeros[level]
        left = count[at]
        return np.where(one, count[-1] + at - left, left)

    def rank(self, value: int, at: np.ndarray) -> np.ndarray:
        """How many of the first ``at`` values equal ``value``."""
        lo, hi = np.zeros(1, np.int64), np.asarray(at, np.int64)
        for level in range(self.bits):
            one = np.bool_(value >> (self.bits - 1 - level) & 1)
            lo, hi = self._down(level, lo, one), self._down(level, hi, one)
        return hi - lo

    def count_less(self, lo: np.ndarray, hi: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many values of places lo..hi-1 are less than ``bound``."""
        lo, hi = np.asarray(lo, np.int64), np.asarray(hi, np.int64)
        bound = np.asarray(bound, np.int64)
        beyond = bound >= 1 << self.bits
        found = np.where(beyond, hi - lo, 0)
        for level in range(self.bits):
            one = (bound >> (self.bits - 1 - level) & 1).astype(bool)
            found += np.where(one & ~beyond, self.zeros[level][hi] - self.zeros[level][lo], 0)
            lo, hi = self._down(level, lo, one), self._down(level, hi, one)
        return found

    def quantile(self, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The k-th least value, from 0, of places lo..hi-1; ``k`` is less than hi - lo."""
        lo, hi = np.asarray(lo, np.int64), np.asarray(hi, np.int64)
        k, value = np.asarray(k, np.int64), np.zeros(len(lo), np.int64)
        for level in range(self.bits):
            none = (self.zeros[level][hi] - self.zeros[level][lo]).astype(np.int64)
            one = k >= none
            k = np.where(one, k - none, k)
            value = value << 1 | one
            lo, hi = self._down(level, lo, one), self._down(level, hi, one)
        return value
