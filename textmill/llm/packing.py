"""Packing of tokenized documents into windows by best-fit decreasing.

A document's ids, with an end id behind, are cut into full windows first; what remains is shorter than a window. The
remains of a block of documents are placed in decreasing order, each into the open window with the least room that still
holds it, or into a new one. A segment tree indexed by remaining room finds that window.

Blocks lie within a task's input, so nothing is shuffled, and they are closed at ``HELD_BYTES`` of held ids: memory
depends neither on the input nor on a text's copies. Windows of a block that stay below ``FULL_PERCENT`` would be mostly
padding where blocks are small; their content is laid end to end instead and cut at powers of two, which need none.

Tokenizers of the kind used here cut texts at blanks and between letters, digits and signs before anything else. So these
parts are tokenized on their own, once per worker as long as they are remembered, which gives what whole texts give.

Edge cases: a null or empty text is the end id alone; a text of any length is tokenized in parts; equal sizes are
placed in the order of the input; repeated rows are documents of their own; an empty table gives no rows; other columns
are ignored. Results depend on how the input is dealt to tasks, not on retries: a task that runs again packs the same.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from textmill.llm import arrow_text as at
from textmill.llm.common import pick

WINDOW = 2048
END_ID = 1
HELD_BYTES = 1 << 25
FULL_PERCENT = 90
REMEMBERED = 1 << 19  # parts
_SLICE_BYTES = 1 << 21
_TASK_BITS = 33
PIECES = "id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


class Piece(NamedTuple):
    id: int | None
    start: int
    ids: bytes  # little-endian, four bytes each
    doc_tokens: int


class RoomTree:
    """Open windows by their room; :meth:`tightest` finds the least room of at least a given size."""

    def __init__(self, window: int):
        self._leaves = 1 << window.bit_length()  # rooms 0 to window
        self._open = [0] * (2 * self._leaves)
        self._windows: list[list[int]] = [[] for _ in range(window + 1)]

    def add(self, room: int, window: int) -> None:
        self._windows[room].append(window)
        self._count(room, 1)

    def take(self, room: int) -> int:
        self._count(room, -1)
        return self._windows[room].pop()

    def _count(self, room: int, by: int) -> None:
        node = room + self._leaves
        while node:
            self._open[node] += by
            node >>= 1

    def tightest(self, size: int) -> int | None:
        node = size + self._leaves
        if self._open[node]:
            return size
        # Up to the first right-hand neighbour with anything open, then down to its least room.
        while node > 1 and (node & 1 or not self._open[node + 1]):
            node >>= 1
        if node <= 1:
            return None
        node += 1
        while node < self._leaves:
            node *= 2
            node += not self._open[node]
        return node - self._leaves


def best_fit(sizes: list[int], window: int = WINDOW) -> list[list[int]]:
    """Windows as lists of item numbers, in the order of placement; every size is at most ``window``."""
    tree, windows = RoomTree(window), []
    for item in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        room = tree.tightest(sizes[item])
        if room is None:
            room = window
            windows.append([])
            tree.add(room, len(windows) - 1)
        chosen = tree.take(room)
        windows[chosen].append(item)
        tree.add(room - sizes[item], chosen)
    return windows


def powers_of_two(total: int, window: int = WINDOW) -> list[int]:
    """Lengths of sequences without padding for ``total`` ids: full windows, then falling powers of two."""
    rest = total % window
    return [window] * (total // window) + [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]


def pack_block(pieces: list[Piece], window: int = WINDOW) -> Iterator[list[Piece]]:
    """The sequences of a block."""
    sizes = [len(p.ids) // 4 for p in pieces]
    loose: list[Piece] = []
    for found in best_fit(sizes, window):
        if 100 * sum(sizes[i] for i in found) >= FULL_PERCENT * window:
            yield [pieces[i] for i in found]
        else:
            loose += [pieces[i] for i in found]
    queue, used = loose[::-1], 0  # ``used`` ids of the last piece are placed
    for length in powers_of_two(sum(len(p.ids) // 4 for p in loose), window):
        sequence = []
        while length:
            piece = queue[-1]
            n = min(length, len(piece.ids) // 4 - used)
            sequence.append(piece._replace(start=piece.start + used, ids=piece.ids[4 * used : 4 * (used + n)]))
            length, used = length - n, used + n
            if 4 * used == len(piece.ids):
                queue.pop()
                used = 0
        yield sequence


_BLANK, _LETTER, _DIGIT, _SIGN, _OTHER = range(5)
_CLASSES = np.full(256, _OTHER, np.uint8)
_CLASSES[33:127] = _SIGN
_CLASSES[np.flatnonzero(~at.NOT_BLANK)] = _BLANK
_CLASSES[48:58] = _DIGIT
_CLASSES[65:91] = _CLASSES[97:123] = _LETTER
_CLASSES[39] = _OTHER  # an apostrophe may belong to what follows


def parts_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, ends): words between blanks, cut into runs of letters, digits and runs of signs.

    A word with anything but these, or with the beginning of a special token, stays whole; in the others A-Z are folded.
    """
    kinds = _CLASSES[data]
    latin = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)) if len(data) else np.zeros(0, int)
    kinds[latin] = kinds[latin + 1] = _LETTER
    kinds[np.flatnonzero((data[:-1] == ord("<")) & (data[1:] == ord("|")))] = _OTHER
    filled = kinds != _BLANK
    begin, finish = filled.copy(), filled.copy()
    begin[1:] &= ~filled[:-1]
    finish[:-1] &= ~filled[1:]
    heads, tails = offsets[:-1][offsets[:-1] < len(data)], offsets[1:][offsets[1:] > 0] - 1
    begin[heads], finish[tails] = filled[heads], filled[tails]
    word = np.cumsum(begin) - 1
    word_ends = np.flatnonzero(finish) + 1
    odd = np.bincount(word[kinds == _OTHER], minlength=len(word_ends)) > 0 if len(word_ends) else np.zeros(0, bool)
    plain = filled.copy()
    plain[filled] = ~odd[word[filled]]
    cut = plain & (kinds == _DIGIT)
    cut[1:] |= plain[1:] & (kinds[1:] != kinds[:-1])
    starts = np.flatnonzero(begin | cut)
    ends = np.minimum(np.append(starts[1:], len(data)), word_ends[word[starts]])
    return np.where(plain, at.FOLD[data], data), starts, ends


class Encoder:
    """Ids of the texts of a column by a vocabulary file of ``tokenizers``.

    Parts are told apart by 64-bit hashes; ids of those seen are kept until there are ``REMEMBERED``.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._forget()

    def _forget(self) -> None:
        self._hashes = np.zeros(0, np.uint64)  # in order, with the place and number of each part's ids
        self._begins = self._sizes = np.zeros(0, np.int64)
        self._ids = np.array([END_ID], np.uint32)

    def _learn(self, hashes: np.ndarray, parts: list[str]) -> None:
        ids, sizes = [self._ids], []
        for low in range(0, len(parts), 10_000):
            some = parts[low : low + 10_000]
            found = self._tokenizer.encode(some, is_pretokenized=True, add_special_tokens=False)
            ids.append(np.array(found.ids, np.uint32))
            sizes.append(np.bincount(np.array(found.word_ids, np.int64), minlength=len(some)))
        sizes = np.concatenate(sizes)
        begins = len(self._ids) + np.cumsum(sizes) - sizes
        place = np.searchsorted(self._hashes, hashes)
        self._hashes = np.insert(self._hashes, place, hashes)
        self._begins, self._sizes = np.insert(self._begins, place, begins), np.insert(self._sizes, place, sizes)
        self._ids = np.concatenate(ids)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows with ``END_ID`` behind each, offsets of the rows)."""
        data, offsets = at.utf8(column)
        data, starts, ends = parts_of(data, offsets)
        first = np.searchsorted(starts, offsets)
        if len(self._hashes) > REMEMBERED:
            self._forget()
        hashes, sample, inverse = np.unique(at.span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        new = np.flatnonzero(~np.isin(hashes, self._hashes))
        if len(new):
            spans = zip(starts[sample[new]].tolist(), ends[sample[new]].tolist())
            self._learn(hashes[new], [data[s:e].tobytes().decode() for s, e in spans])
        place = np.searchsorted(self._hashes, hashes)[inverse.ravel()]
        begins, sizes = np.insert(self._begins[place], first[1:], 0), np.insert(self._sizes[place], first[1:], 1)
        done = np.concatenate([[0], np.cumsum(sizes)])
        places = np.arange(done[-1]) - np.repeat(done[:-1] - begins, sizes)
        return self._ids[places], done[first + np.arange(len(first))]


_IN_WORKER: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _IN_WORKER:
        _IN_WORKER[path] = Encoder(path)
    return _IN_WORKER[path]


def _rows(sequences: Iterable[list[Piece]], numbers: Iterator[int]) -> Iterator[pa.RecordBatch]:
    """Rows of the sequences, in batches of some megabytes."""
    columns: list[list] = [[] for _ in range(7)]
    size = 0

    def batch() -> pa.RecordBatch:
        kinds = [pa.binary() if k == 3 else pa.int64() for k in range(7)]
        names = [field.split()[0] for field in PIECES.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

    for sequence in sequences:
        number, offset = next(numbers), 0
        for piece in sequence:
            n = len(piece.ids) // 4
            for column, value in zip(columns, (piece.id, piece.start, n, piece.ids, piece.doc_tokens, number, offset)):
                column.append(value)
            offset += n
            size += len(piece.ids)
        if size > 1 << 22:
            yield batch()
            columns, size = [[] for _ in range(7)], 0
    if columns[0]:
        yield batch()


def _pack_batches(batches: Iterable[pa.RecordBatch], path: str, window: int, held_bytes: int) -> Iterator[pa.RecordBatch]:
    context = TaskContext.get()
    numbers = iter(range((context.partitionId() if context else 0) << _TASK_BITS, 1 << 63))
    held: list[Piece] = []
    size = 0
    for batch in at.slices(batches, "text", _SLICE_BYTES):
        ids, offsets = encoder(path).encode(batch.column("text"))
        full: list[list[Piece]] = []
        for key, start, end in zip(batch.column("id").to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist()):
            n = end - start
            cut = n - n % window
            for k in range(0, cut, window):
                full.append([Piece(key, k, ids[start + k : start + k + window].astype("<u4").tobytes(), n)])
            if cut < n:
                held.append(Piece(key, cut, ids[start + cut : end].astype("<u4").tobytes(), n))
                size += 4 * (n - cut) + 200
        yield from _rows(full, numbers)
        if size >= held_bytes:
            yield from _rows(pack_block(held, window), numbers)
            held, size = [], 0
    yield from _rows(pack_block(held, window), numbers)


def pack(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, held_bytes: int = HELD_BYTES
) -> DataFrame:
    """One row per piece: id, start (its document's ids before it), length, ids (binary, little-endian unsigned 32-bit),
    doc_tokens (with the end id), sequence_id and offset (there, without gaps).

    ``vocabulary`` is the path of a tokenizer file that every machine has. A sequence holds ``window`` ids at most; one
    whose length is no power of two is to be padded to ``window``.
    """
    picked = pick(docs, id=id_col, text=text_col)
    picked = picked.withColumn("id", picked["id"].cast("long"))
    return picked.mapInArrow(lambda batches: _pack_batches(batches, vocabulary, window, held_bytes), PIECES)
