"""Counting quotient filters without loss: sets of packed keys with counts, sorted, compact and mergeable.

A key of two lanes of equally many bits is permuted, so that keys of any kind spread evenly, and the
permutation can be undone. The permuted key's first bits are its quotient, all others its
remainder, so a key can be told from every other. A filter holds its keys in order: for each
quotient, how many keys have it (so many ones and a zero), then every key's remainder and count.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np

from dormouse.llm.bytetext import mixed

_ROUNDS = tuple(np.uint64(k) for k in (0x243F6A8885A308D3, 0x13198A2E03707344, 0xA4093822299F31D0, 0x082EFA98EC4E6C89))
_HEADER = struct.Struct("<QIIBBB")
# Counts up to this less one take a byte; others follow as whole numbers.
_MANY = 255


def _mask(bits: int) -> np.uint64:
    return np.uint64((1 << bits) - 1)


def permuted(high: np.ndarray, low: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A pseudorandom permutation of pairs of ``bits``-bit numbers."""
    for key in _ROUNDS:
        high, low = low, high ^ (mixed(low + key) & _mask(bits))
    return high, low


def restored(high: np.ndarray, low: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    for key in reversed(_ROUNDS):
        high, low = low ^ (mixed(high + key) & _mask(bits)), high
    return high, low


@dataclass
class Counts:
    """Different permuted keys in order, and how often each occurs. Lanes have ``bits`` bits, 62 at most."""

    high: np.ndarray
    low: np.ndarray
    counts: np.ndarray
    bits: int

    def __len__(self) -> int:
        return len(self.counts)

    def part(self, start: int, stop: int) -> Counts:
        return Counts(self.high[start:stop], self.low[start:stop], self.counts[start:stop], self.bits)


def _order(high: np.ndarray, low: np.ndarray, bits: int) -> np.ndarray:
    """Sorts by the first 64 bits of both lanes; where that leaves pairs in doubt, by all."""
    if 2 * bits <= 64:
        return np.argsort((high << np.uint64(bits)) | low)
    first = (high << np.uint64(64 - bits)) | (low >> np.uint64(2 * bits - 64))
    order = np.argsort(first)
    first, tail = first[order], low[order]
    if ((first[1:] == first[:-1]) & (tail[1:] < tail[:-1])).any():
        return np.lexsort((low, high))
    return order


def counted(high: np.ndarray, low: np.ndarray, counts: np.ndarray | None, bits: int) -> Counts:
    """Permuted keys, repeated ones too, as one sorted set; without ``counts`` each counts once."""
    order = _order(high, low, bits)
    high, low = high[order], low[order]
    new = np.ones(len(high), bool)
    new[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
    first = np.flatnonzero(new)
    if counts is None:
        total = np.diff(np.append(first, len(high)))
    else:
        total = np.add.reduceat(counts[order], first) if len(first) else counts[:0]
    return Counts(high[first], low[first], total.astype(np.int64), bits)


def merged(filters: list[Counts]) -> Counts:
    """One set of all keys; counts of equal ones are added."""
    return counted(
        np.concatenate([f.high for f in filters]),
        np.concatenate([f.low for f in filters]),
        np.concatenate([f.counts for f in filters]),
        filters[0].bits,
    )


def by_prefix(counts: Counts, prefix_bits: int) -> list[tuple[int, Counts]]:
    """The set cut into those with equal first bits, with these bits."""
    prefix = counts.high >> np.uint64(counts.bits - prefix_bits)
    starts = np.flatnonzero(np.concatenate(([True], prefix[1:] != prefix[:-1]))) if len(prefix) else prefix[:0]
    stops = np.append(starts[1:], len(prefix)).astype(np.int64)
    return [(int(prefix[a]), counts.part(a, b)) for a, b in zip(starts.tolist(), stops.tolist())]


def _planes(values: np.ndarray, bits: int) -> bytes:
    """As many low bytes of each value as the bits need, all first bytes first."""
    width = -(-bits // 8)
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _from_planes(data: memoryview, count: int, bits: int) -> tuple[np.ndarray, int]:
    width = -(-bits // 8)
    whole = np.zeros((count, 8), np.uint8)
    whole[:, :width] = np.frombuffer(data, np.uint8, width * count).reshape(width, count).T
    return whole.view("<u8").ravel().astype(np.uint64), width * count


def packed(counts: Counts, prefix: int, prefix_bits: int) -> bytes:
    """The set as a filter, whose keys all begin with the prefix. About one quotient for each key."""
    size, bits = len(counts), counts.bits
    quotient_bits = min(bits - prefix_bits, max(0, (size - 1).bit_length()))
    rest_bits = bits - prefix_bits - quotient_bits
    quotient = (counts.high >> np.uint64(rest_bits)) & _mask(quotient_bits)
    runs = np.zeros(size + (1 << quotient_bits), bool)
    runs[np.arange(size) + quotient.astype(np.int64)] = True
    many = counts.counts >= _MANY
    return b"".join((
        _HEADER.pack(prefix, size, int(many.sum()), prefix_bits, quotient_bits, bits),
        np.packbits(runs).tobytes(),
        _planes(counts.high & _mask(rest_bits), rest_bits),
        _planes(counts.low, bits),
        np.minimum(counts.counts, _MANY).astype(np.uint8).tobytes(),
        counts.counts[many].astype("<i8").tobytes(),
    ))


def unpacked(data: bytes) -> Counts:
    prefix, size, many, prefix_bits, quotient_bits, bits = _HEADER.unpack_from(data)
    view, at = memoryview(data), _HEADER.size
    run_bits = size + (1 << quotient_bits)
    width = -(-run_bits // 8)
    ones = np.flatnonzero(np.unpackbits(np.frombuffer(view[at : at + width], np.uint8), count=run_bits))
    at += width
    rest_bits = bits - prefix_bits - quotient_bits
    rest, used = _from_planes(view[at:], size, rest_bits)
    at += used
    low, used = _from_planes(view[at:], size, bits)
    at += used
    counts = np.frombuffer(view[at : at + size], np.uint8).astype(np.int64)
    at += size
    if many:
        counts[counts == _MANY] = np.frombuffer(view[at : at + 8 * many], "<i8")
    quotient = (ones - np.arange(size)).astype(np.uint64)
    first = np.uint64(prefix << (bits - prefix_bits)) if prefix_bits else np.uint64(0)
    return Counts(first | (quotient << np.uint64(rest_bits)) | rest, low, counts, bits)
