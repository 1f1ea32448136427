"""Words and their hashes of whole Arrow text columns, as numpy arrays.

The functions work on slices of a column of at most `SLICE` bytes (a longer text is a slice of its own), so the memory of a
worker follows the longest text and not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE = 1 << 20
#: Most texts of a slice, so that a place among them fits into 16 bits.
TEXTS = 1 << 16
_BASE = np.uint64(0x9E3779B97F4A7C55)
_U = np.uint64

_SPACES = np.zeros(256, bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True
#: Words of the contracts: runs without space and without the five controls 09 to 0D.
PLAIN_WORDS = ~_SPACES
#: Words for comparisons: letters, digits and every byte of a longer code point.
_ALNUM = np.zeros(256, bool)
for _low, _high in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    _ALNUM[_low : _high + 1] = True
NORMAL_WORDS = _ALNUM

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def powers(n: int, _kept: list[np.ndarray] = [np.ones(1, np.uint64)]) -> np.ndarray:  # noqa: B006
    """The first n powers of the hash base, modulo 2^64."""
    if len(_kept[0]) < n:
        grown = np.full(max(n, 64, 2 * len(_kept[0])), _BASE, np.uint64)
        grown[0] = 1
        _kept[0] = np.multiply.accumulate(grown)
    return _kept[0]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


@dataclass
class Words:
    """Words of the texts `first` to `first + n` of a column; `doc` counts from 0 within the slice."""

    first: int
    n: int
    data: np.ndarray
    text_start: np.ndarray  # n + 1 byte offsets
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    hash: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.bincount(self.doc, minlength=self.n)

    @property
    def doc_start(self) -> np.ndarray:
        """Place of each text's first word; n + 1 entries."""
        return np.concatenate(([0], np.cumsum(self.counts)))


def as_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    offset = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, offset


def slices(column: pa.Array, limit: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, end text, bytes, offsets into the bytes) of consecutive slices."""
    raw, offset = as_buffer(column)
    first, n = 0, len(offset) - 1
    while first < n:
        end = int(np.searchsorted(offset, offset[first] + limit, "right")) - 1
        end = min(n, first + TEXTS, max(first + 1, end))
        yield first, end, raw[offset[first] : offset[end]], offset[first : end + 1] - offset[first]
        first = end


def lower(data: np.ndarray, wide: bool = False) -> np.ndarray:
    """A-Z in lower case; with `wide` also the Latin-1 letters of two bytes."""
    out = _LOWER[data]
    if wide and len(out) > 1:
        second = (out[:-1] == 0xC3) & (out[1:] >= 0x80) & (out[1:] <= 0x9E) & (out[1:] != 0x97)
        out[1:][second] += 0x20
    return out


def words(column: pa.Array, keep: np.ndarray = PLAIN_WORDS, fold: bool = True, wide: bool = False) -> Iterator[Words]:
    """The words of each slice: maximal runs of the bytes in `keep`, hashed in lower case if `fold`."""
    for first, end, raw, offset in slices(column):
        n = end - first
        data = lower(raw, wide) if fold else raw
        inside = keep[data]
        begins, ends = inside.copy(), inside.copy()
        if len(data):
            begins[1:] &= ~inside[:-1]
            ends[:-1] &= ~inside[1:]
            cuts = offset[1:-1]
            cuts = cuts[(cuts > 0) & (cuts < len(data))]
            begins[cuts] = inside[cuts]
            ends[cuts - 1] = inside[cuts - 1]
        start = np.flatnonzero(begins)
        stop = np.flatnonzero(ends) + 1
        size = stop - start
        if len(start):
            at = np.cumsum(size) - size
            place = np.arange(int(size.sum())) - np.repeat(at, size)
            value = data[inside].astype(np.uint64)
            value += _U(1)
            value *= powers(int(size.max()))[place]
            hashed = mix(np.add.reduceat(value, at) + size.astype(np.uint64))
        else:
            hashed = np.zeros(0, np.uint64)
        doc = np.searchsorted(offset, start, "right") - 1
        yield Words(first, n, data, offset, start, stop, doc, hashed)


def prefix_hashes(w: Words, lengths: range) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length: places of the words of at least so many bytes, and hashes of their first bytes."""
    power = powers(max(lengths) + 1)
    size = w.end - w.start
    total = np.zeros(len(size), np.uint64)
    for k in range(max(lengths)):
        longer = size > k
        total[longer] += (w.data[w.start[longer] + k].astype(np.uint64) + _U(1)) * power[k]
        if k + 1 in lengths:
            at = np.flatnonzero(longer)
            yield at, mix(total[at] + _U(0x51ED2700 + k))


def grams(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Place of the first word and hash of every run of k words within a text; a shorter text is one run."""
    counts, begin = w.counts, w.doc_start[:-1]
    n = len(w.hash)
    total = np.zeros(n, np.uint64)
    last = np.repeat(begin + counts, counts)
    at = np.arange(n)
    for j in range(k):
        here = at + j < last
        total[here] += mix(w.hash[at[here] + j] + _U(j + 1)) * powers(k + 1)[j]
    whole = at + k <= last
    short = (counts > 0) & (counts < k)
    whole[begin[short]] = True
    places = np.flatnonzero(whole)
    return places, mix(total[places])


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column of the given run lengths."""
    offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))
