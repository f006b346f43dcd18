"""Words of Arrow string columns as numpy arrays, inside tasks.

A batch is cut into slices of half a megabyte of text, so temporary arrays don't grow with the batch. Words are runs of
the bytes that a table marks; both tables used here treat every byte of a character outside ASCII alike.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 19


def mix64(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of a splitmix generator; works on unsigned arrays, in place."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def numbers(n: int, seed: int) -> np.ndarray:
    """``n`` fixed odd 64-bit numbers."""
    return mix64(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


_BASE = int(numbers(1, 7)[0])
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_VALUES = numbers(256, 11)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}

FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32  # A-Z
NOT_BLANK = np.ones(256, bool)
NOT_BLANK[[9, 10, 11, 12, 13, 32]] = False
LETTER_OR_DIGIT = np.zeros(256, bool)  # after folding: digits, a-z and everything outside ASCII
LETTER_OR_DIGIT[48:58] = LETTER_OR_DIGIT[97:123] = LETTER_OR_DIGIT[128:] = True


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n of the hash base and of its inverse."""
    if len(_powers["up"]) <= n:
        for name, base in (("up", _BASE), ("down", _BASE_INVERSE)):
            steps = np.full(n + 1, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def slices(batches: Iterable[pa.RecordBatch], column: str, max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut so that the texts of each are below ``max_bytes``, or a single text."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        start = 0
        while start < len(sizes):
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + max_bytes, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the offsets of its rows; a null is empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    low = int(offsets[0]) if len(offsets) else 0
    high = int(offsets[-1]) if len(offsets) else 0
    data = np.frombuffer(data, np.uint8)[low:high] if data is not None and high > low else np.zeros(0, np.uint8)
    return data, offsets - low


class Words(NamedTuple):
    data: np.ndarray  # folded bytes
    offsets: np.ndarray  # of rows, in bytes
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # of rows, in words
    hashes: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def row_ends(self) -> np.ndarray:
        """For each word, the word index at which its row ends."""
        return np.repeat(self.first[1:], self.counts())

    def text(self, start: int, stop: int) -> bytes:
        return b" ".join(self.data[s:e].tobytes() for s, e in zip(self.starts[start:stop], self.ends[start:stop]))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes, by differences of one running sum."""
    up, down = powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * up[: len(data)], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * down[starts]
    hashes += (ends - starts).astype(np.uint64)
    return mix64(hashes)


def words(column: pa.Array, is_word: np.ndarray) -> Words:
    data, offsets = utf8(column)
    data = FOLD[data]
    mask = is_word[data]
    begin, finish = mask.copy(), mask.copy()
    begin[1:] &= ~mask[:-1]
    finish[:-1] &= ~mask[1:]
    heads = offsets[:-1][offsets[:-1] < len(data)]
    tails = offsets[1:][offsets[1:] > 0] - 1
    begin[heads] = mask[heads]
    finish[tails] = mask[tails]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(finish) + 1
    first = np.searchsorted(starts, offsets)
    return Words(data, offsets, starts, ends, first, span_hashes(data, starts, ends))
