"""Word and line scanning of whole Arrow text columns with numpy, a bounded slice at a time."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_ODD = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _STEP)
_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """The first ``n`` powers of the hash base; the table grows with the longest run seen."""
    global _powers
    if len(_powers) < n:
        size = max(n, 2 * len(_powers), 4096)
        steps = np.full(size, _ODD, np.uint64)
        steps[0] = 1
        _powers = np.multiply.accumulate(steps)
    return _powers[:n] if n < len(_powers) else _powers


def flags(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


WORD = ~flags(bytes(SPACES))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple]:
    """Cut a text column into runs of rows of about ``limit`` bytes: first row, bytes, offsets.

    NULL counts as empty. A text longer than the limit forms a slice of its own.
    """
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, bounds, data = column.buffers()
    if not len(column):
        return
    offsets = np.frombuffer(bounds, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), len(column))
        yield (
            first,
            data[offsets[first] : offsets[last]],
            offsets[first : last + 1] - offsets[first],
        )
        first = last


def row_sums(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
    return total[offsets[1:]] - total[offsets[:-1]]


def run_hashes(data: np.ndarray, at: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
    """A hash of each run of bytes; ``at`` lists all their positions, run after run."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    place = np.arange(len(at)) - np.repeat(starts, lengths)
    values = _BYTE[data[at]] * powers(int(lengths.max()))[place]
    return mix(np.add.reduceat(values, starts) + lengths.astype(np.uint64) * _STEP)


@dataclass
class Words:
    """The words of a slice in order: their row, byte range and hash."""

    row: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    inside: np.ndarray

    def per_row(self, rows: int) -> np.ndarray:
        return np.bincount(self.row, minlength=rows)


def scan_words(data: np.ndarray, offsets: np.ndarray, word: np.ndarray = WORD) -> Words:
    """Find the maximal runs of word bytes inside each row."""
    inside = word[data]
    if not inside.any():
        none = np.zeros(0, np.int64)
        return Words(none, none, none, np.zeros(0, np.uint64), inside)
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.concatenate(([False], inside[:-1])) & ~edge[:-1]
    after = np.concatenate((inside[1:], [False])) & ~edge[1:]
    begin = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    lengths = end - begin
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    hashes = run_hashes(data, np.flatnonzero(inside), starts, lengths)
    row = np.searchsorted(offsets, begin, "right") - 1
    return Words(row, begin, end, hashes, inside)


def windows(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the ``size`` words from each word on, and whether they all lie in one row."""
    n = len(words.hash) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    value = words.hash[:n].copy()
    for i in range(1, size):
        value = value * _ODD + words.hash[i : n + i]
    return mix(value), words.row[:n] == words.row[size - 1 :]


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur more than once."""
    ordered = np.sort(keys)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return np.zeros(len(keys), bool)
    return twice[np.minimum(np.searchsorted(twice, keys), len(twice) - 1)] == keys


def salted_by_row(keys: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Keys that are equal only within one row."""
    return mix(keys ^ mix((row + 1).astype(np.uint64) * _STEP))
