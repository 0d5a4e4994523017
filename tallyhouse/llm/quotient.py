"""Counting quotient filters of packed n-grams: lossless, compact, sorted, and merged by adding counters.

An n-gram of word ids, ``bits`` each, is a number of n * bits bits. An invertible permutation of these numbers spreads
them evenly; the top bits of the permuted number are its bucket, the next ones its quotient, and the rest, kept in full,
the remainder. A filter holds the entries of one bucket in order: run lengths of the quotients in unary, the remainders
in as many bytes as they need, the counters in one byte where they fit. Nothing is lost, so counts are exact and the
n-grams come back from the filter alone.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

U = np.uint64
_MIX = (U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F), U(0x165667B19E3779F9), U(0xD6E8FEB86659FD93))


def mixed(x: np.ndarray, turn: int) -> np.ndarray:
    """64 bits out of 64 bits, in which every bit depends on all."""
    x = (x ^ _MIX[turn % 4]) * _MIX[(turn + 1) % 4]
    x = (x ^ (x >> U(32))) * _MIX[(turn + 2) % 4]
    return x ^ (x >> U(29))


def _mask(bits: int) -> np.uint64:
    return U((1 << bits) - 1)


@dataclass(frozen=True)
class Layout:
    """How n-grams of ``n`` ids of ``bits`` bits become a high and a low half, and how many bits of the high half choose a bucket."""

    n: int
    bits: int
    bucket_bits: int

    @property
    def high(self) -> int:
        return min(64, max(self.n * self.bits - self.low, self.bucket_bits))

    @property
    def low(self) -> int:
        return self.n // 2 * self.bits

    def packed(self, ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The ids one behind the other: the first half of them (and the odd one) high, the others low."""
        halves, cut = [], self.n - self.n // 2
        for some in (ids[:cut], ids[cut:]):
            total = np.zeros(len(ids[0]), dtype=U)
            for i in some:
                total = (total << U(self.bits)) | i.astype(U)
            halves.append(total)
        return halves[0], halves[1]

    def unpacked(self, high: np.ndarray, low: np.ndarray) -> list[np.ndarray]:
        cut = self.n - self.n // 2
        places = [(high, cut - 1 - k) for k in range(cut)] + [(low, self.n - cut - 1 - k) for k in range(self.n - cut)]
        return [((half >> U(self.bits * place)) & _mask(self.bits)).astype(np.int64) for half, place in places]

    def permuted(self, high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Four Feistel steps over the two halves, which may differ in width."""
        for turn in (0, 2):
            high = high ^ (mixed(low, turn) & _mask(self.high))
            low = low ^ (mixed(high, turn + 1) & _mask(self.low))
        return high, low

    def restored(self, high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        for turn in (2, 0):
            low = low ^ (mixed(high, turn + 1) & _mask(self.low))
            high = high ^ (mixed(low, turn) & _mask(self.high))
        return high, low

    def bucket(self, high: np.ndarray) -> np.ndarray:
        return (high >> U(self.high - self.bucket_bits)).astype(np.int64)


def summed(high: np.ndarray, low: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The entries in order, equal ones as one with the sum of their counts (1 each where none are given)."""
    if not len(high):
        return high, low, np.zeros(0, dtype=np.int64)
    order = np.lexsort((low, high))
    high, low = high[order], low[order]
    first = np.flatnonzero(np.append(True, (high[1:] != high[:-1]) | (low[1:] != low[:-1])))
    if counts is None:
        total = np.diff(np.append(first, len(high)))
    else:
        total = np.add.reduceat(counts[order], first)
    return high[first], low[first], total.astype(np.int64)


def _as_bytes(values: np.ndarray, bits: int) -> bytes:
    width = -(-bits // 8)
    return np.ascontiguousarray(values.astype("<u8")[:, None].view(np.uint8)[:, :width]).tobytes()


def _from_bytes(data: memoryview, count: int, bits: int) -> np.ndarray:
    width = -(-bits // 8)
    wide = np.zeros((count, 8), dtype=np.uint8)
    if width and count:
        wide[:, :width] = np.frombuffer(data, np.uint8, count * width).reshape(count, width)
    return wide.view("<u8").ravel().astype(U)


def encode(layout: Layout, high: np.ndarray, low: np.ndarray, counts: np.ndarray) -> bytes:
    """The filter of sorted, distinct entries of one bucket."""
    left = layout.high - layout.bucket_bits  # bits of the high half below the bucket
    q = min(left, max(0, len(high).bit_length() - 1))
    inside = high & _mask(left)
    quotient = (inside >> U(left - q)).astype(np.int64)
    # unary: as many ones as a quotient has entries, then a zero
    ones = np.zeros((1 << q) + len(high), dtype=np.uint8)
    ones[quotient + np.arange(len(high))] = 1
    small = np.where(counts < 255, counts, 255).astype(np.uint8)
    return b"".join([
        len(high).to_bytes(4, "little"), q.to_bytes(1, "little"), np.packbits(ones).tobytes(),
        _as_bytes(inside & _mask(left - q), left - q), _as_bytes(low, layout.low),
        small.tobytes(), counts[counts >= 255].astype("<i8").tobytes(),
    ])


def decode(layout: Layout, bucket: int, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What ``encode`` was given."""
    view = memoryview(data)
    count, q = int.from_bytes(view[:4], "little"), view[4]
    left, at = layout.high - layout.bucket_bits, 5
    size = -(-((1 << q) + count) // 8)
    ones = np.flatnonzero(np.unpackbits(np.frombuffer(view[at : at + size], np.uint8), count=(1 << q) + count))
    at += size
    quotient = (ones - np.arange(count)).astype(U)
    rest = _from_bytes(view[at:], count, left - q)
    at += count * -(-(left - q) // 8)
    low = _from_bytes(view[at:], count, layout.low)
    at += count * -(-layout.low // 8)
    counts = np.frombuffer(view[at : at + count], np.uint8).astype(np.int64)
    wide = np.flatnonzero(counts == 255)
    if len(wide):
        counts[wide] = np.frombuffer(view[at + count :], "<i8", len(wide))
    return (U(bucket) << U(left)) | (quotient << U(left - q)) | rest, low, counts


class Merged:
    """Filters of one bucket, merged one by one: as long as less is pending than is merged, it waits."""

    def __init__(self, layout: Layout, bucket: int):
        self.layout, self.bucket, self.pending, self.size = layout, bucket, [], 0

    def add(self, data: bytes) -> None:
        self.pending.append(decode(self.layout, self.bucket, data))
        self.size += len(self.pending[-1][0])
        if self.size > 2 * len(self.pending[0][0]) + 10_000:
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if len(self.pending) > 1:
            self.pending = [summed(*map(np.concatenate, zip(*self.pending)))]
            self.size = len(self.pending[0][0])
        return self.pending[0]


# ---- members, approximately -----------------------------------------------------------------------------------------


def marks(high: np.ndarray, low: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two places of 2^bits for each entry."""
    value = mixed(high ^ mixed(low, 2), 3)
    return value >> U(64 - bits), (value >> U(4)) & _mask(bits)


def marked(high: np.ndarray, low: np.ndarray, bits: int) -> bytes:
    """A bit set of 2^bits bits with the entries' places: says "yes" for all of them and, seldom, for others."""
    held = np.zeros(1 << bits, dtype=bool)
    for place in marks(high, low, bits):
        held[place] = True
    return np.packbits(held).tobytes()


@dataclass
class Members:
    """The bit sets of all buckets, one behind the other."""

    layout: Layout
    bits: int
    data: np.ndarray

    def holds(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """Of permuted entries: whether they may be members. No member is missed."""
        base = self.layout.bucket(high).astype(U) << U(self.bits)
        found = np.ones(len(high), dtype=bool)
        for place in marks(high, low, self.bits):
            at = base | place
            found &= (self.data[(at >> U(3)).astype(np.int64)] >> (U(7) - (at & U(7))).astype(np.uint8)) & 1 == 1
        return found
