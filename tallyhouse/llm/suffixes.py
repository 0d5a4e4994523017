"""Suffixes chosen by content, their order, and the windows they stand for."""

from __future__ import annotations

import numpy as np

PIECE_BYTES = 1 << 18
_PLACE_BITS = np.uint64(21)
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def _powers(base: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        steps = np.full(n, base, dtype=np.uint64)
        steps[0] = 1
        return np.multiply.accumulate(steps)


class Anchors:
    """Chooses one anchor for every window of ``length`` bytes: the place in it whose ``prefix`` bytes hash lowest.

    Equal windows choose the same place, so they meet in the suffixes that start at anchors; successive windows with
    one anchor make a run, and a text has about 2 / (length - prefix + 2) runs a byte.
    """

    def __init__(self, length: int, prefix: int):
        self.length, self.prefix = length, prefix
        room = PIECE_BYTES + length + prefix
        self.up = _powers(_BASE, room)
        self.down = _powers(pow(_BASE, -1, 1 << 64), room)

    def runs(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first window, windows, anchor) of every run; ``data`` holds several texts that end at ``ends``."""
        length, prefix = self.length, self.prefix
        if len(data) < length:
            none = np.zeros(0, np.int64)
            return none, none, none
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[: len(data)], out=sums[1:])
        order = (sums[prefix:] - sums[:-prefix]) * self.down[: len(data) - prefix + 1]
        order ^= order >> np.uint64(32)
        order *= np.uint64(0xD6E8FEB86659FD93)
        order ^= order >> np.uint64(29)
        order = (order >> _PLACE_BITS << _PLACE_BITS) | np.arange(len(order), dtype=np.uint64)
        lowest = _sliding_minimum(order, length - prefix + 1)
        change = np.zeros(len(lowest) + 1, dtype=np.int32)
        starts = np.r_[0, ends[:-1]]
        has = ends - starts >= length
        np.add.at(change, starts[has], 1)
        np.add.at(change, ends[has] - length + 1, -1)
        valid = np.cumsum(change[:-1]) > 0
        first = valid.copy()
        first[1:] &= ~valid[:-1] | (lowest[1:] != lowest[:-1])
        at = np.flatnonzero(first)
        last = valid.copy()
        last[:-1] &= ~valid[1:] | first[1:]
        n = np.flatnonzero(last) - at + 1
        return at, n, (lowest[at] & ((np.uint64(1) << _PLACE_BITS) - np.uint64(1))).astype(np.int64)


def _sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    n = len(values)
    padded = np.full(-(-n // width) * width, np.uint64(_MASK))
    padded[:n] = values
    table = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])
