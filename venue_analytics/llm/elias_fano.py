"""Elias-Fano sequences in numpy: sorted 64-bit numbers in about 2 + log2(range / n) bits each, searched in place.

Every operation takes arrays of queries. All parts are flat arrays, so a sequence can be a view into a
memory-mapped file.
"""

from __future__ import annotations

import json
import struct

import numpy as np

U64 = np.uint64
_ONE = U64(1)


def _select_in_word(words: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Place of the r-th set bit (from 0) of each word."""
    place = np.zeros(len(words), dtype=np.int64)
    r = r.copy()
    for width in (32, 16, 8, 4, 2, 1):
        low = words & U64((1 << width) - 1)
        below = np.bitwise_count(low).astype(np.int64)
        up = r >= below
        r -= below * up
        place += width * up
        words = np.where(up, words >> U64(width), low)
    return place


class EliasFano:
    def __init__(self, n: int, low_bits: int, last_high: int, low: np.ndarray, high: np.ndarray, zeros: np.ndarray):
        self.n, self.low_bits, self.last_high = n, low_bits, last_high
        self.low, self.high, self.zeros = low, high, zeros

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        """From numbers in ascending order (uint64; equal ones allowed)."""
        n = len(values)
        if not n:
            return cls(0, 0, -1, np.zeros(1, U64), np.zeros(1, U64), np.zeros(1, np.int64))
        low_bits = max(0, int(int(values[-1]) // n).bit_length() - 1)
        highs = (values >> U64(low_bits)).astype(np.int64)
        low = np.zeros(n * low_bits // 64 + 2, dtype=U64)
        if low_bits:
            lows = values & U64((1 << low_bits) - 1)
            at = np.arange(n, dtype=np.int64) * low_bits
            word, shift = at >> 6, (at & 63).astype(U64)
            np.bitwise_or.at(low, word, lows << shift)
            over = np.flatnonzero((at & 63) + low_bits > 64)
            np.bitwise_or.at(low, word[over] + 1, lows[over] >> (U64(64) - shift[over]))
        ones = highs + np.arange(n, dtype=np.int64)
        high = np.zeros((int(highs[-1]) + n >> 6) + 1, dtype=U64)
        np.bitwise_or.at(high, ones >> 6, _ONE << (ones & 63).astype(U64))
        zeros = np.concatenate([[0], np.cumsum(64 - np.bitwise_count(high).astype(np.int64))])
        return cls(n, low_bits, int(highs[-1]), low, high, zeros)

    def _select0(self, k: np.ndarray) -> np.ndarray:
        """Place of the k-th zero of the high bits; past the last, as if zeros went on."""
        k = np.minimum(k, self.zeros[-1] - 1)
        word = np.searchsorted(self.zeros, k, side="right") - 1
        return (word << 6) + _select_in_word(~self.high[word], k - self.zeros[word])

    def _lows(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), dtype=U64)
        at = i * self.low_bits
        word, shift = at >> 6, (at & 63).astype(U64)
        upper = np.where(shift == 0, U64(0), self.low[word + 1] << ((U64(64) - shift) & U64(63)))
        return ((self.low[word] >> shift) | upper) & U64((1 << self.low_bits) - 1)

    def __getitem__(self, i: np.ndarray) -> np.ndarray:
        ones = (np.arange(len(self.zeros), dtype=np.int64) << 6) - self.zeros if len(i) > len(self.zeros) else None
        if ones is None:  # ones before a word are 64 * word - zeros: search without making the list
            lo, hi = np.zeros(len(i), np.int64), np.full(len(i), len(self.zeros) - 1, np.int64)
            while (open_ := hi - lo > 1).any():
                mid = (lo + hi) >> 1
                right = (mid << 6) - self.zeros[mid] <= i
                lo, hi = np.where(open_ & right, mid, lo), np.where(open_ & ~right, mid, hi)
            word = lo
        else:
            word = np.searchsorted(ones, i, side="right") - 1
        place = (word << 6) + _select_in_word(self.high[word], i - ((word << 6) - self.zeros[word]))
        return ((place - i).astype(U64) << U64(self.low_bits)) | self._lows(i)

    def find(self, x: np.ndarray, start: np.ndarray | None = None, stop: np.ndarray | None = None) -> np.ndarray:
        """Index of each number, or -1; with start and stop only from start up to stop, by successor search."""
        out = np.full(len(x), -1, dtype=np.int64)
        if not self.n:
            return out
        high = (x >> U64(self.low_bits)).astype(np.int64)
        own = np.flatnonzero((high <= self.last_high) & (high >= 0))
        if not len(own):
            return out
        x, high = x[own], high[own]
        lo = np.where(high == 0, 0, self._select0(np.maximum(high - 1, 0)) + 1 - high)
        hi = np.where(high == self.last_high, self.n, self._select0(high) - high)
        if start is not None:
            lo, hi = np.maximum(lo, start[own]), np.minimum(hi, stop[own])
        end = hi
        low = x & U64((1 << self.low_bits) - 1)
        while (open_ := lo < hi).any():
            mid = (lo + hi) >> 1
            less = self._lows(np.minimum(mid, self.n - 1)) < low
            lo, hi = np.where(open_ & less, mid + 1, lo), np.where(open_ & ~less, mid, hi)
        there = lo < end
        there[there] = self._lows(lo[there]) == low[there]
        out[own[there]] = lo[there]
        return out

    def parts(self, name: str) -> dict[str, np.ndarray]:
        return {f"{name}.size": np.array([self.n, self.low_bits, self.last_high], np.int64), f"{name}.low": self.low, f"{name}.high": self.high, f"{name}.zeros": self.zeros}

    @classmethod
    def view(cls, arrays: dict[str, np.ndarray], name: str) -> EliasFano:
        n, low_bits, last_high = map(int, arrays[f"{name}.size"])
        return cls(n, low_bits, last_high, arrays[f"{name}.low"], arrays[f"{name}.high"], arrays[f"{name}.zeros"])


def pack(arrays: dict[str, np.ndarray]) -> bytes:
    """Flat arrays as one file: a header and the arrays, each at a multiple of eight bytes."""
    places, at = {}, 0
    for name, a in arrays.items():
        places[name] = (a.dtype.str, len(a), at)
        at += -(-a.nbytes // 8) * 8
    header = json.dumps(places).encode()
    header += b" " * (-(len(header) + 8) % 8)
    return struct.pack("<q", len(header)) + header + b"".join(a.tobytes() + b"\0" * (-a.nbytes % 8) for a in arrays.values())


def mapped(path: str) -> dict[str, np.ndarray]:
    """The arrays of a packed file as views into its memory map."""
    whole = np.memmap(path, dtype=np.uint8, mode="r")
    size = struct.unpack("<q", whole[:8].tobytes())[0]
    places = json.loads(whole[8 : 8 + size].tobytes())
    base = 8 + size
    return {k: whole[base + at : base + at + n * np.dtype(kind).itemsize].view(kind) for k, (kind, n, at) in places.items()}
