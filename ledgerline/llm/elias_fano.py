"""Elias-Fano sequences over a flat buffer, read by vectorised searches.

A strictly or weakly rising sequence of n numbers keeps the low bits of each
number packed, and its high part in unary: bit ``high + i`` is set for number
i. Ranks per word of the unary part, and the word of every 32nd one and zero,
make both kinds of select a short walk.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
STEP = 5  # select starts from every 32nd one and zero
ONES, TOPS = U(0x0101010101010101), U(0x8080808080808080)
_SELECT = np.zeros((256, 8), np.uint8)
for _byte in range(256):
    _places = [b for b in range(8) if _byte >> b & 1]
    _SELECT[_byte, :len(_places)] = _places
_SELECT = _SELECT.ravel()


def select_in_word(x: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Place of the k-th (from 0) one of each 64-bit word, which has it."""
    upto = x - ((x >> U(1)) & U(0x5555555555555555))
    upto = (upto & U(0x3333333333333333)) + ((upto >> U(2)) & U(0x3333333333333333))
    upto = ((upto + (upto >> U(4))) & U(0x0F0F0F0F0F0F0F0F)) * ONES  # byte i: ones in bytes 0 to i
    k = k.astype(U)
    shift = ((((((k * ONES) | TOPS) - upto) & TOPS) >> U(7)) * ONES >> U(56)) << U(3)  # 8 x bytes with at most k ones so far
    k -= ((upto << U(8)) >> shift) & U(255)
    return (shift + _SELECT[(((x >> shift) & U(255)) << U(3)) | k]).astype(np.int64)


def encode(values: np.ndarray) -> dict[str, np.ndarray]:
    """Arrays that EliasFano reads."""
    values = np.asarray(values, U)
    n = len(values)
    last = int(values[-1]) if n else 0
    bits = max(0, ((last + 1) // max(n, 1)).bit_length() - 1)
    index = np.arange(n, dtype=U)
    low = values & U((1 << bits) - 1)
    packed = np.zeros(n * bits // 64 + 2, U)
    if bits:
        at = index * U(bits)
        word, shift = (at >> U(6)).astype(np.int64), at & U(63)
        np.bitwise_or.at(packed, word, low << shift)
        over = shift + U(bits) > U(64)
        np.bitwise_or.at(packed, word[over] + 1, low[over] >> (U(64) - shift[over]))
    place = ((values >> U(bits)) + index).astype(np.int64)
    size = (last >> bits) + n + 1
    upper = np.zeros(size // 64 + 2, U)
    np.bitwise_or.at(upper, place >> 6, U(1) << (place & 63).astype(U))
    rank = np.zeros(len(upper) + 1, np.int64)
    np.cumsum(np.bitwise_count(upper), out=rank[1:])
    zeros = np.arange(len(rank)) * 64 - rank
    hint = lambda r, total: np.r_[np.searchsorted(r, np.arange(0, total + 1, 1 << STEP), "right") - 1, len(upper) - 1].astype(np.uint32)
    return {"head": np.array([n, bits, last], np.int64), "low": packed, "upper": upper, "rank": rank.astype(np.uint32 if n < 2**32 else np.int64),
            "ones": hint(rank, n), "zeros": hint(zeros, int(zeros[-1]))}


class EliasFano:
    def __init__(self, arrays: dict[str, np.ndarray]):
        self.n, self.bits, self.last = (int(x) for x in arrays["head"])
        self.low, self.upper, self.rank = arrays["low"], arrays["upper"], arrays["rank"]
        self.hints = {True: arrays["ones"], False: arrays["zeros"]}

    def _select(self, k: np.ndarray, ones: bool) -> np.ndarray:
        """Place of the k-th (from 0) one or zero of the unary part."""
        before = (lambda w: self.rank[w].astype(np.int64)) if ones else (lambda w: 64 * w - self.rank[w].astype(np.int64))
        hints, step = self.hints[ones], k >> STEP
        word = hints[step].astype(np.int64)
        on = np.flatnonzero(before(word + 1) <= k)
        if len(on):
            a, b, want = word[on] + 1, hints[step[on] + 1].astype(np.int64), k[on]
            word[on] = a
            open_ = np.flatnonzero(a < b)
            while len(open_):
                on, a, b, want = on[open_], a[open_], b[open_], want[open_]
                mid = (a + b + 1) >> 1
                there = before(mid) <= want
                a, b = np.where(there, mid, a), np.where(there, b, mid - 1)
                word[on] = a
                open_ = np.flatnonzero(a < b)
        raw = self.upper[word] if ones else ~self.upper[word]
        return word * 64 + select_in_word(raw, k - before(word))

    def _next(self, place: np.ndarray, k: np.ndarray, ones: bool) -> np.ndarray:
        """Place of the k-th one or zero, the first of its kind from ``place`` on."""
        word = place >> 6
        raw = (self.upper[word] if ones else ~self.upper[word]) >> (place & 63).astype(U)
        out = place + np.bitwise_count((raw & (~raw + U(1))) - U(1))
        far = np.flatnonzero(raw == 0)
        if len(far):
            out[far] = self._select(k[far], ones)
        return out

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(i), np.int64)
        at = i * self.bits
        word, shift = at >> 6, (at & 63).astype(U)
        high = np.where(shift > 0, self.low[word + 1] << ((U(64) - shift) & U(63)), U(0))
        return (((self.low[word] >> shift) | high) & U((1 << self.bits) - 1)).astype(np.int64)

    def access(self, i: np.ndarray) -> np.ndarray:
        """The numbers at positions ``i``."""
        i = np.asarray(i, np.int64)
        return ((self._select(i, True) - i) << self.bits) | self._low(i)

    def access_two(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers at positions ``i`` and ``i + 1``."""
        place = self._select(i, True)
        after = self._next(place + 1, i + 1, True)
        return ((place - i) << self.bits) | self._low(i), ((after - i - 1) << self.bits) | self._low(i + 1)

    def find(self, x: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Position of ``x`` among positions lo to hi, or -1: the successor of
        x there, if it is x. Numbers with x's high part lie between two zeros
        of the unary part; among these a binary search compares low bits."""
        x, lo, hi = (np.asarray(a, np.int64) for a in (x, lo, hi))
        out = np.full(len(x), -1, np.int64)
        live = np.flatnonzero((x >= 0) & (x <= self.last) & (lo < hi))
        if not len(live):
            return out
        high, low = x[live] >> self.bits, x[live] & ((1 << self.bits) - 1)
        begin = np.where(high > 0, self._select(np.maximum(high - 1, 0), False) + 1, 0)
        a, end = np.maximum(begin - high, lo[live]), np.minimum(self._next(begin, high, False) - high, hi[live])
        b = end.copy()
        while (on := np.flatnonzero(a < b)).size:
            mid = (a[on] + b[on]) >> 1
            less = self._low(mid) < low[on]
            a[on] = np.where(less, mid + 1, a[on])
            b[on] = np.where(less, b[on], mid)
        inside = np.flatnonzero(a < end)
        hit = inside[self._low(a[inside]) == low[inside]]
        out[live[hit]] = a[hit]
        return out
