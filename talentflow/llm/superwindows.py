"""Windows grouped by their minimiser.

The minimiser of a window of k elements is the m-element run inside it with
the smallest hash (the leftmost on ties).  It depends on the window's content
only, so equal windows have equal minimisers at equal offsets - wherever they
stand.  Consecutive windows that share one minimiser form a super-window: one
row instead of k-m of them, keyed by the minimiser's hash.  Grouping
super-windows by that key brings all equal windows together and loses none.
"""

from __future__ import annotations

import numpy as np

from .tokens import U64, Powers, mix, range_hashes

POSITION_BITS = 30  # positions within one block
CLASS_POWERS = Powers(0xC2B2AE3D27D4EB4F)


def leftmost_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the smallest value (leftmost on ties of its upper 34 bits)
    of every run of ``width`` values, by doubling spans."""
    low = U64((1 << POSITION_BITS) - 1)
    cur = (values & ~low) | np.arange(len(values), dtype=U64)
    n, span = len(values) - width + 1, 1
    while span * 2 <= width:
        cur = np.minimum(cur[:-span], cur[span:])
        span *= 2
    cur = np.minimum(cur[:n], cur[width - span : width - span + n])
    return (cur & low).astype(np.int64)


class SuperWindows:
    """The super-windows of a block.  ``values`` are the elements' 64-bit
    hashes, ``bounds`` the element range of each row."""

    def __init__(self, values: np.ndarray, bounds: np.ndarray, k: int, m: int, powers: Powers):
        self.k = k
        n = len(values)
        empty = np.zeros(0, np.int64)
        self.first = self.count = self.row = self.offset = empty
        self.key = np.zeros(0, U64)
        if n < k:
            return
        starts = np.arange(n - m + 1)
        grams = range_hashes(values, starts, starts + m, powers)
        where = leftmost_minimum(grams, k - m + 1)
        # windows that stay within their row
        ok = np.zeros(n + 1, np.int64)
        lo, hi = bounds[:-1], bounds[1:] - k + 1
        some = hi > lo
        np.add.at(ok, lo[some], 1)
        np.add.at(ok, hi[some], -1)
        at = np.flatnonzero(np.cumsum(ok)[: n - k + 1])
        if not len(at):
            return
        pos = where[at]
        cut = np.flatnonzero(np.concatenate([[True], (pos[1:] != pos[:-1]) | (at[1:] != at[:-1] + 1)]))
        self.first = at[cut]  # element index of the first window
        self.count = np.diff(np.concatenate([cut, [len(at)]]))  # number of windows
        self.offset = pos[cut] - self.first  # of the minimiser from the first window
        self.key = grams[pos[cut]]
        self.row = np.searchsorted(bounds, self.first, "right") - 1

    def take(self, keep: np.ndarray) -> "SuperWindows":
        for name in ("first", "count", "offset", "key", "row"):
            setattr(self, name, getattr(self, name)[keep])
        return self

    def classes(self, values: np.ndarray) -> np.ndarray:
        """Hash of a super-window's whole content and the minimiser's place:
        equal for super-windows with the same windows in the same order."""
        body = range_hashes(values, self.first, self.first + self.count + self.k - 1, CLASS_POWERS)
        return mix(body + self.offset.astype(U64) * U64(0x9FB21C651E98DF25))


def covered(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Boolean mask of the elements in the union of [start, end)."""
    delta = np.zeros(n + 1, np.int64)
    np.add.at(delta, starts, 1)
    np.add.at(delta, ends, -1)
    return np.cumsum(delta)[:n] > 0
