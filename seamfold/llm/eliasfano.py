"""Elias-Fano sequences over numpy arrays, with vectorized access and search."""

from __future__ import annotations

import numpy as np

_SIX, _LOW6, _FULL = np.uint64(6), np.uint64(63), np.uint64(0xFFFFFFFFFFFFFFFF)
_EACH, _TOP = np.uint64(0x0101010101010101), np.uint64(0x8080808080808080)
#: The position of each set bit of each byte, 8 for bits that it does not have.
_IN_BYTE = np.array([([i for i in range(8) if b >> i & 1] + [8] * 8)[:8] for b in range(256)], np.int64).reshape(-1)


def _select_in_word(word: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Position of the rank-th (from 0) set bit of each word."""
    two, four = np.uint64(0x3333333333333333), np.uint64(0x0F0F0F0F0F0F0F0F)
    n = word - ((word >> np.uint64(1)) & np.uint64(0x5555555555555555))
    n = (n & two) + ((n >> np.uint64(2)) & two)
    # how many bits are set up to and with each byte
    upto = ((n + (n >> np.uint64(4))) & four) * _EACH
    rank = rank.astype(np.uint64)
    byte = np.minimum(np.bitwise_count((((rank * _EACH) | _TOP) - upto) & _TOP), 7).astype(np.uint64) << np.uint64(3)
    before = (upto << np.uint64(8)) >> byte & np.uint64(255)
    return byte.astype(np.int64) + _IN_BYTE[((word >> byte & np.uint64(255)) << np.uint64(3) | np.minimum(rank - before, np.uint64(7))).astype(np.int64)]


class EliasFano:
    """A non-decreasing sequence of n numbers: low bits packed, high parts in unary.

    Number i has its high part as the number of zeros before the i-th one of `high`.
    `ones` counts the ones before each 64-bit word of it.
    """

    def __init__(self, n: int, bits: int, low: np.ndarray, high: np.ndarray, ones: np.ndarray) -> None:
        self.n, self.bits, self.low, self.high, self.ones = n, bits, low, high, ones
        self.zeros = np.arange(len(ones), dtype=np.int64) * 64 - ones

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        top = int(values[-1]) + 1 if n else 1
        bits = max(0, (top // max(1, n)).bit_length() - 1)
        low = np.zeros((n * bits + 63) // 64 + 2, np.uint64)
        if bits:
            rest = values & np.uint64((1 << bits) - 1)
            at = np.arange(n, dtype=np.uint64) * np.uint64(bits)
            np.bitwise_or.at(low, (at >> _SIX).astype(np.int64), rest << (at & _LOW6))
            over = (at & _LOW6) + np.uint64(bits) > np.uint64(64)
            np.bitwise_or.at(low, (at[over] >> _SIX).astype(np.int64) + 1, rest[over] >> (np.uint64(64) - (at[over] & _LOW6)))
        place = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        size = (int(place[-1]) if n else 0) + 2
        flags = np.zeros((size + 63) // 64 * 64, bool)
        flags[place] = True
        high = np.packbits(flags, bitorder="little").view(np.uint64)
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(high).astype(np.int64))]).astype(np.uint32)
        return cls(n, bits, low, high, ones)

    def arrays(self) -> list[np.ndarray]:
        return [np.array([self.n, self.bits], np.int64), self.low, self.high, self.ones]

    @classmethod
    def of(cls, head: np.ndarray, low: np.ndarray, high: np.ndarray, ones: np.ndarray) -> EliasFano:
        return cls(int(head[0]), int(head[1]), low, high, ones)

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(i), np.uint64)
        at = i.astype(np.uint64) * np.uint64(self.bits)
        word, shift = (at >> _SIX).astype(np.int64), at & _LOW6
        beyond = np.where(shift > 0, self.low[word + 1] << ((np.uint64(64) - shift) & _LOW6), np.uint64(0))
        return ((self.low[word] >> shift) | beyond) & np.uint64((1 << self.bits) - 1)

    def access(self, i: np.ndarray) -> np.ndarray:
        """The numbers at places i."""
        word = np.searchsorted(self.ones, i, side="right") - 1
        place = word * 64 + _select_in_word(self.high[word], i - self.ones[word])
        return ((place - i).astype(np.uint64) << np.uint64(self.bits)) | self._low(i)

    def _before(self, h: np.ndarray) -> np.ndarray:
        """How many numbers have a high part below h."""
        zeros = self.zeros
        rank = h - 1
        word = np.minimum(np.searchsorted(zeros, rank, side="right") - 1, len(self.high) - 1)
        place = word * 64 + _select_in_word(~self.high[word], rank - zeros[word])
        return np.where(h <= 0, 0, np.where(rank >= zeros[-1], self.n, np.minimum(place - rank, self.n)))

    def find(self, x: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The place in [start, end) of the successor of x if it is x itself, else -1."""
        h = (x >> np.uint64(self.bits)).astype(np.int64)
        want = x & np.uint64((1 << self.bits) - 1)
        out = np.full(len(x), -1, np.int64)
        lo = self._before(h)
        # the first number with this high part is a set bit behind that many numbers and zeros; it is often the one
        bit = np.minimum(lo + h, len(self.high) * 64 - 1)
        there = (lo < self.n) & ((self.high[bit >> 6] >> (bit & 63).astype(np.uint64) & np.uint64(1)) > 0)
        at = np.flatnonzero(there & (lo < end))
        low = self._low(lo[at])
        hit = (low == want[at]) & (lo[at] >= start[at])
        out[at[hit]] = lo[at[hit]]
        at = at[~hit & (low <= want[at])]
        if len(at):
            low_end, hi, want = np.maximum(start[at], lo[at]), np.minimum(end[at], self._before(h[at] + 1)), want[at]
            stop = hi.copy()
            while (left := low_end < hi).any():
                mid = (low_end + hi) >> 1
                less = self._low(np.minimum(mid, self.n - 1)) < want
                low_end, hi = np.where(left & less, mid + 1, low_end), np.where(left & ~less, mid, hi)
            inside = np.flatnonzero(low_end < stop)
            found = low_end[inside]
            out[at[inside]] = np.where(self._low(found) == want[inside], found, -1)
        return out


class Successors:
    """For each context 0..m-1 its ascending successor ids, as one Elias-Fano sequence.

    Ids are stored relative to what stands before their context's range, which makes
    the whole sequence monotone; a search moves the id by the same amount.
    """

    def __init__(self, starts: EliasFano, ids: EliasFano) -> None:
        self.starts, self.ids = starts, ids

    def pointers(self, context: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end of the contexts' ranges, and what their ids are relative to."""
        start, end = self.starts.access(context).astype(np.int64), self.starts.access(context + 1).astype(np.int64)
        return start, end, np.where(start > 0, self.ids.access(np.maximum(start - 1, 0)), np.uint64(0))

    @classmethod
    def build(cls, context: np.ndarray, ids: np.ndarray, n_contexts: int) -> Successors:
        """context, ids: sorted pairs."""
        starts = np.searchsorted(context, np.arange(n_contexts + 1))
        last = np.zeros(n_contexts + 1, np.uint64)
        full = np.flatnonzero(np.diff(starts))
        last[full + 1] = ids[starts[full + 1] - 1].astype(np.uint64)
        base = np.cumsum(last)[:-1]
        return cls(EliasFano.build(starts), EliasFano.build(ids.astype(np.uint64) + base[context] if len(ids) else np.zeros(0, np.uint64)))

    def find(self, context: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """The place of each (context, id), or -1."""
        if not len(context) or not self.ids.n:
            return np.full(len(context), -1, np.int64)
        # equal contexts that follow each other share their pointers
        new = np.concatenate([[True], context[1:] != context[:-1]])
        of = np.cumsum(new) - 1
        start, end, base = self.pointers(context[new])
        return self.ids.find(ids.astype(np.uint64) + base[of], start[of], end[of])

    def arrays(self) -> list[np.ndarray]:
        return [*self.starts.arrays(), *self.ids.arrays()]

    @classmethod
    def of(cls, a: list[np.ndarray]) -> Successors:
        return cls(EliasFano.of(*a[:4]), EliasFano.of(*a[4:]))


def dump(arrays: list[np.ndarray]) -> bytes:
    """Arrays one after the other, each at a multiple of 8 bytes, behind a table of kinds and sizes."""
    head, body, at = [f"{len(arrays)}"], [], 0
    for a in arrays:
        raw = np.ascontiguousarray(a).tobytes()
        head.append(f"{a.dtype.str},{len(a)},{at}")
        body.append(raw + b"\0" * (-len(raw) % 8))
        at += len(body[-1])
    return ";".join(head).encode().ljust(4096) + b"".join(body)


def load(whole) -> list[np.ndarray]:
    """The arrays of a dumped block (a mapped file, or memory), not copied."""
    head = bytes(whole[:4096]).decode().strip().split(";")[1:]
    return [np.frombuffer(whole, np.dtype(k), int(n), 4096 + int(at)) for k, n, at in (x.split(",") for x in head)]
