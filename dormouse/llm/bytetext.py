"""Columns of text as byte arrays inside tasks: slices, words, lines and their hashes, without a loop over words.

Hashes have 64 bits. They name words, lines and shingles; two different ones among n get one
name with a probability of about n^2 / 2^65.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text that are worked on at a time; a longer text is worked on alone.
SLICE_BYTES = 1 << 20

_ODD = np.uint64(0x9E3779B97F4A7C15)
_ODD_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """A table of 256 flags, set for the bytes of the ranges, ends included."""
    table = np.zeros(256, bool)
    for first, last in ranges:
        table[first : last + 1] = True
    return table


# Words end at a blank or a control character from tab to carriage return.
NOT_BLANK = ~byte_set((0x20, 0x20), (0x09, 0x0D))
# Words are of ASCII letters, ASCII digits and everything beyond ASCII.
LETTERS = byte_set((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))


def _byte_values(lower: bool) -> np.ndarray:
    values = mixed(np.arange(1, 257, dtype=np.uint64) * _ODD)
    if lower:
        values[0x41:0x5B] = values[0x61:0x7B]
    return values


def mixed(hashes: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of the argument."""
    h = hashes.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


_VALUES = {lower: _byte_values(lower) for lower in (False, True)}
_powers: dict[int, np.ndarray] = {}


def powers(base: np.uint64, count: int) -> np.ndarray:
    """base^0 up to base^(count - 1) modulo 2^64, kept for the next call until ``forget``."""
    known = _powers.get(int(base))
    if known is None or len(known) < count:
        size = 1 << max(16, int(count - 1).bit_length())
        known = np.full(size, base, np.uint64)
        known[0] = 1
        np.multiply.accumulate(known, out=known)
        if size <= 4 * SLICE_BYTES:
            _powers[int(base)] = known
    return known[:count]


def forget() -> None:
    """Drops what is kept between calls."""
    _powers.clear()


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with about ``limit`` bytes of text, or one row if that has more."""
    if batch.num_rows == 0:
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths.astype(np.int64) + 1)
    at, done = 0, 0
    while at < batch.num_rows:
        stop = max(at + 1, int(np.searchsorted(ends, done + limit, "right")))
        yield batch.slice(at, stop - at)
        at, done = stop, int(ends[stop - 1])


@dataclass
class Texts:
    """The texts of a column, end to end: their bytes, and where each begins (one more than texts)."""

    data: np.ndarray
    offsets: np.ndarray

    @classmethod
    def of(cls, column: pa.Array) -> Texts:
        """A null becomes an empty text."""
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        column = pc.fill_null(column, "").cast(pa.large_string())
        _, offsets, data = column.buffers()
        offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
        if data is None or not len(offsets):
            return cls(np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64))
        data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
        return cls(data, offsets - offsets[0])

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def of_positions(self, positions: np.ndarray) -> np.ndarray:
        """The number of the text that holds each byte position."""
        return np.searchsorted(self.offsets, positions, "right") - 1

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """How many flagged bytes each text has."""
        total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return total[self.offsets[1:]] - total[self.offsets[:-1]]

    def runs(self, member: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the longest runs of the set's bytes; none reaches over two texts."""
        if not len(self.data):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        inside = member[self.data]
        before = np.empty_like(inside)
        before[0], before[1:] = False, inside[:-1]
        first = self.offsets[:-1]
        before[first[first < len(inside)]] = False
        starts = np.flatnonzero(inside & ~before)
        after = np.empty_like(inside)
        after[-1], after[:-1] = False, inside[1:]
        last = self.offsets[1:] - 1
        after[last[last >= 0]] = False
        return starts, np.flatnonzero(inside & ~after) + 1

    def hashes(self, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
        """A hash for each byte range; equal for equal bytes, with A-Z as a-z if asked."""
        if not len(starts):
            return np.zeros(0, np.uint64)
        terms = _VALUES[lower][self.data]
        terms *= powers(_ODD, len(terms))
        total = np.empty(len(terms) + 1, np.uint64)
        total[0] = 0
        np.cumsum(terms, out=total[1:])
        h = (total[ends] - total[starts]) * powers(_ODD_INVERSE, len(terms) + 1)[starts]
        return mixed(h + (ends - starts).astype(np.uint64))


def per_text(numbers: np.ndarray, count: int) -> np.ndarray:
    """How often each of 0 to count - 1 occurs."""
    return np.bincount(numbers, minlength=count).astype(np.int64)


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` neighbours, by its first."""
    count = max(0, len(hashes) - size + 1)
    total = np.zeros(count, np.uint64)
    for i in range(size):
        total = total * _ODD + hashes[i : i + count]
    return mixed(total)


def replaced(batch: pa.RecordBatch, names: list[str], arrays: list) -> pa.RecordBatch:
    """A batch of the given arrays; numpy arrays become Arrow arrays."""
    made = [a if isinstance(a, pa.Array) else pa.array(a) for a in arrays]
    return pa.RecordBatch.from_arrays(made, names=names)
