"""Elias-Fano sequences: monotone integers in about 2 + log2(universe / n) bits each, with vectorised access and search."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

ONE, SIX, LAST = np.uint64(1), np.uint64(6), np.uint64(63)
POPCOUNT = np.array([bin(i).count("1") for i in range(256)], np.uint8)
#: SELECT[byte, r]: place of the r-th one of a byte
SELECT = np.zeros((256, 8), np.uint8)
for _b in range(256):
    for _r, _p in enumerate(p for p in range(8) if _b >> p & 1):
        SELECT[_b, _r] = _p


def _select(words: np.ndarray, before: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Places of the r-th bits of words, `before` being the bits before each word of the bitmap."""
    w = np.searchsorted(before, r, "right") - 1
    left = (r - before[w]).astype(np.int64)
    own = words[w].view(np.uint8).reshape(-1, 8)
    sums = np.cumsum(POPCOUNT[own], axis=1, dtype=np.uint8)
    byte = (sums <= left[:, None]).sum(1)
    at = np.arange(len(r))
    left -= np.where(byte > 0, sums[at, byte - 1], 0)
    return w * 64 + byte * 8 + SELECT[own[at, byte], left]


@dataclass
class EliasFano:
    n: int
    low_bits: int
    low: np.ndarray  # packed low parts
    high: np.ndarray  # unary high parts: bit (value >> low_bits) + index is set
    ones: np.ndarray  # ones before each word of high
    zeros: np.ndarray  # zeros before each word of high

    @staticmethod
    def of(values: np.ndarray) -> EliasFano:
        """From ascending values."""
        v = np.asarray(values, np.uint64)
        n = len(v)
        top = int(v[-1]) + 1 if n else 1
        bits = min(63, max(0, (top // max(n, 1)).bit_length() - 1))
        place = (v >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        words = (int(place[-1]) if n else 0) // 64 + 2
        flags = np.zeros(words * 64, bool)
        flags[place] = True
        high = np.packbits(flags, bitorder="little").view(np.uint64)
        low = np.zeros(n * bits // 64 + 2, np.uint64)
        if bits:
            part = v & np.uint64((1 << bits) - 1)
            start = np.arange(n, dtype=np.uint64) * np.uint64(bits)
            w, s = (start >> SIX).astype(np.int64), start & LAST
            np.bitwise_or.at(low, w, part << s)
            over = (s > 0) & (s + np.uint64(bits) > 64)
            np.bitwise_or.at(low, w[over] + 1, part[over] >> (np.uint64(64) - s[over]))
        ones = np.r_[0, np.cumsum(flags.reshape(-1, 64).sum(1))[:-1]].astype(np.uint32)
        return EliasFano(n, bits, low, high, ones, (np.arange(words, dtype=np.int64) * 64 - ones).astype(np.uint32))

    def arrays(self) -> list[np.ndarray]:
        return [np.array([self.n, self.low_bits], np.uint64), self.low, self.high, self.ones, self.zeros]

    @staticmethod
    def from_arrays(a: list[np.ndarray]) -> EliasFano:
        return EliasFano(int(a[0][0]), int(a[0][1]), *a[1:])

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.uint64)
        start = i.astype(np.uint64) * np.uint64(self.low_bits)
        w, s = (start >> SIX).astype(np.int64), start & LAST
        out = self.low[w] >> s
        over = s + np.uint64(self.low_bits) > 64
        out[over] |= self.low[w[over] + 1] << (np.uint64(64) - s[over])
        return out & np.uint64((1 << self.low_bits) - 1)

    def access(self, i: np.ndarray) -> np.ndarray:
        """Values at the places i."""
        i = np.asarray(i, np.int64)
        if not len(i):
            return np.zeros(0, np.uint64)
        high = _select(self.high, self.ones, i) - i
        return high.astype(np.uint64) << np.uint64(self.low_bits) | self._low(i)

    def successor(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of the first value >= x, whether it equals x); place n where there is none."""
        x = np.asarray(x, np.uint64)
        place, equal = np.full(len(x), self.n, np.int64), np.zeros(len(x), bool)
        h = (x >> np.uint64(self.low_bits)).astype(np.int64)
        most = len(self.high) * 64 - self.n - 1  # zeros of high, the last place left out
        fit = np.flatnonzero(h < most) if self.n else np.zeros(0, np.int64)
        if not len(fit):
            return place, equal
        h, want = h[fit], x[fit] & np.uint64((1 << self.low_bits) - 1)
        flipped = _Flipped(self.high)
        hi = _select(flipped, self.zeros, h) - h
        lo = np.zeros(len(h), np.int64)
        some = h > 0
        lo[some] = _select(flipped, self.zeros, h[some] - 1) - (h[some] - 1)
        end = hi.copy()
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                break
            mid = (lo[open_] + hi[open_]) >> 1
            less = self._low(mid) < want[open_]
            lo[open_] = np.where(less, mid + 1, lo[open_])
            hi[open_] = np.where(less, hi[open_], mid)
        place[fit] = lo
        inside = np.flatnonzero(lo < end)
        equal[fit[inside]] = self._low(lo[inside]) == want[inside]
        return place, equal


class _Flipped:
    """Words of a bitmap with ones and zeros exchanged, on access."""

    def __init__(self, words: np.ndarray):
        self.words = words

    def __getitem__(self, at):
        return ~self.words[at]
