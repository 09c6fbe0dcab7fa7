"""Vectorised word and window hashes over Arrow text columns.

A block is a run of whole texts of bounded size (or one longer text).  Words
are maximal runs of bytes outside space and \\t..\\r, unchanged; their hashes
and those of word windows come from prefix sums of a polynomial over 2**64, so
nothing loops over characters or words in Python.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
U64 = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64-bit values (multiply and xor-shift)."""
    x = (x ^ (x >> U64(31))) * U64(0x7FB5D329728EA185)
    x = (x ^ (x >> U64(27))) * U64(0x81DADEF4BC2DD44D)
    return x ^ (x >> U64(33))


BYTE_VALUES = mix(np.arange(1, 257, dtype=U64))
IS_BLANK = np.zeros(256, bool)
IS_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, U64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            ones = np.ones(1, U64)
            self.up = np.concatenate([ones, np.cumprod(np.full(size - 1, self.base, U64))])
            self.down = np.concatenate([ones, np.cumprod(np.full(size - 1, self.inverse, U64))])
        return self.up[:n], self.down[:n]


BYTE_POWERS = Powers(0x9E3779B97F4A7C15)
WORD_POWERS = Powers(0xD1342543DE82EF95)


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: Powers) -> np.ndarray:
    """Hash of values[s:e] for each range; equal ranges have equal hashes."""
    up, down = powers.get(len(values) + 1)
    prefix = np.zeros(len(values) + 1, U64)
    np.cumsum(values * up[: len(values)], out=prefix[1:])
    return mix((prefix[ends] - prefix[starts]) * down[starts])


def text_blocks(column: pa.Array, max_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, row offsets) for consecutive runs of rows; nulls are
    empty.  A run holds at most ``max_bytes`` unless it is a single row."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("") if column.null_count else column
    column = column.cast(pa.large_string())
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    row = 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + max_bytes, "right")) - 1)
        yield row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


class Words:
    """The words of a block: byte ranges, hashes and the row of each."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        solid = ~IS_BLANK[data]
        first = np.zeros(len(data) + 1, bool)
        first[offsets] = True
        before = np.concatenate([[False], solid[:-1]]) if len(data) else solid
        starts = solid & (~before | first[:-1])
        after = np.concatenate([solid[1:], [False]]) if len(data) else solid
        ends = solid & (~after | first[1:])
        self.starts = np.flatnonzero(starts)
        self.ends = np.flatnonzero(ends) + 1
        self.hashes = range_hashes(BYTE_VALUES[data], self.starts, self.ends, BYTE_POWERS)
        self.bounds = np.searchsorted(self.starts, offsets)  # word range of each row

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of every run of k words within one row."""
        n = len(self.hashes)
        if n < k:
            return np.zeros(0, np.int64), np.zeros(0, U64)
        at = np.arange(n - k + 1)
        row = np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))
        at = at[row[at] == row[at + k - 1]]
        return at, range_hashes(self.hashes, at, at + k, WORD_POWERS)

    def shingles(self, k: int) -> list[np.ndarray]:
        """Per row the sorted distinct hashes of its k-word runs; a row of fewer
        words has one, of all its words; a row without words has none."""
        at, hashes = self.windows(k)
        cuts = np.searchsorted(at, self.bounds)
        out = []
        for r in range(len(self.bounds) - 1):
            lo, hi = self.bounds[r], self.bounds[r + 1]
            if hi - lo >= k:
                out.append(np.unique(hashes[cuts[r] : cuts[r + 1]]))
            elif hi > lo:
                out.append(range_hashes(self.hashes[lo:hi], np.array([0]), np.array([hi - lo]), WORD_POWERS))
            else:
                out.append(np.zeros(0, U64))
        return out
