"""Numpy views of Arrow text batches: slices of bounded size, words, and hashes of any range.

Range hashes: with random odd ``q`` and a random value per unit, ``prefix[i]``
sums value x q^i (mod 2^64), so the hash of units [a, b) is
``(prefix[b] - prefix[a]) * q^-a``, for all ranges at once.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
NULL_ID = 2**63 - 1  # a null doc_id is ordered last

BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x ^ (x >> U64(32))
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    return x


_BASES: dict[int, tuple[int, int, np.ndarray]] = {}
_POWERS: dict[int, np.ndarray] = {}


def _base(seed: int) -> tuple[int, int, np.ndarray]:
    """q, its inverse mod 2^64, and the value of each byte."""
    if seed not in _BASES:
        rng = np.random.default_rng(7919 + seed)
        q = int(rng.integers(2**62)) * 4 + 3
        _BASES[seed] = q, pow(q, -1, 2**64), rng.integers(2**64, size=256, dtype=U64)
    return _BASES[seed]


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 16), base, U64)
        steps[0] = 1
        have = _POWERS[base] = np.cumprod(steps, dtype=U64)
    return have[:n]


class RangeHash:
    """Hashes of ranges of a sequence of unit values."""

    def __init__(self, values: np.ndarray, seed: int = 0):
        q, self.inverse, _ = _base(seed)
        self.prefix = np.zeros(len(values) + 1, U64)
        np.cumsum(values * _powers(q, len(values)), dtype=U64, out=self.prefix[1:])

    @classmethod
    def of_bytes(cls, data: np.ndarray, seed: int = 0) -> RangeHash:
        return cls(_base(seed)[2][data], seed)

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (self.prefix[b] - self.prefix[a]) * _powers(self.inverse, len(self.prefix))[a]

    def all_of(self, n: int) -> np.ndarray:
        """The hash of every range of ``n`` units."""
        count = max(0, len(self.prefix) - n)
        return (self.prefix[n:] - self.prefix[:count]) * _powers(self.inverse, count)


@dataclass
class Slice:
    """Some texts (or one piece of a long text) in one run of bytes."""

    data: np.ndarray     # uint8
    starts: np.ndarray   # of each text in data
    ends: np.ndarray
    rows: np.ndarray     # row number in the batch
    first_unit: int = 0  # of a later piece of a long text: its first byte in the text


def text_column(batch: pa.RecordBatch, name: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    column = batch.column(name).cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), offsets


def slices(data: np.ndarray, offsets: np.ndarray, limit: int = 1 << 20, overlap: int = 0) -> Iterator[Slice]:
    """Texts in slices of about ``limit`` bytes; longer texts in pieces that overlap by ``overlap`` bytes.

    Without ``overlap`` a long text stays whole.
    """
    n, i = len(offsets) - 1, 0
    while i < n:
        if overlap and offsets[i + 1] - offsets[i] > 2 * limit:
            a, end = int(offsets[i]), int(offsets[i + 1])
            for at in range(a, max(a + 1, end - overlap), limit):
                piece = data[at:min(end, at + limit + overlap)]
                yield Slice(piece, np.array([0]), np.array([len(piece)]), np.array([i]), at - a)
            i += 1
            continue
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        if overlap:  # stop before a long text
            long = np.flatnonzero(np.diff(offsets[i:j + 1]) > 2 * limit)
            j = i + int(long[0]) if len(long) else j
        at = offsets[i:j + 1] - offsets[i]
        yield Slice(data[offsets[i]:offsets[j]], at[:-1], at[1:], np.arange(i, j))
        i = j


def doc_ids(batch: pa.RecordBatch) -> np.ndarray:
    return np.asarray(batch.column("doc_id").cast(pa.int64()).fill_null(NULL_ID))


def text_tags(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A 32-bit tag per text: tells rows with one doc_id and different texts apart."""
    view = memoryview(data)
    return np.fromiter(
        (zlib.crc32(view[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)), np.uint32, len(offsets) - 1)


def word_bounds(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word starts, word ends, first word number of each text + total) in a slice; texts do not share words."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~BLANK[data]
    a = inside[1:] & ~inside[:-1]
    b = inside[:-1] & ~inside[1:]
    a, b = a[:len(data) + 1], b[:len(data) + 1]
    # A text may end in a word that the next text seems to go on with: cut there.
    cuts = starts[(starts > 0) & (starts < len(data))]
    if len(cuts):
        cuts = cuts[inside[cuts] & inside[cuts + 1]]
        a[cuts] = True
        b[cuts] = True
    word_starts, word_ends = np.flatnonzero(a), np.flatnonzero(b)
    return word_starts, word_ends, np.append(np.searchsorted(word_starts, starts), len(word_starts))
