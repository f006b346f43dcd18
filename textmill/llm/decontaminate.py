"""Benchmark decontamination by a broadcast set of n-gram hashes.

The benchmark's windows (ten consecutive words, or all words of a shorter item) are hashed into sorted arrays, which are
broadcast; documents stay where they are. A task hashes every window of its documents, looks the hashes up behind a
small table of bits, and verifies each hit by comparing the words themselves. Words inside a verified window are hit.

A benchmark is broadcast only up to ``limit_bytes`` of text. A larger one is dealt by item into parts below the limit
and the documents pass through one scan per part, each adding to the hits found so far, with a written table between.

Edge cases: a null text has no words; items without words match nothing; rows with a null item id hit words, but name no
item; repeated item ids are one item; repeated documents are scanned one by one; an empty benchmark hits nothing;
other columns keep their names in :func:`remove_spans` and are ignored by :func:`find`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm import arrow_text as at
from textmill.llm.common import pick
from textmill.storage import stage_table

WINDOW = 10
LIMIT_BYTES = 16 << 20
_BITS = 20
FOUND = "id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
_STATE = "id long, text string, spans array<int>, items array<string>"


class Index(NamedTuple):
    """Windows of one length, sorted by hash."""

    length: int
    hashes: np.ndarray
    starts: np.ndarray  # first word of the window in the benchmark
    rows: np.ndarray  # its row in the benchmark
    bits: np.ndarray


class Benchmark(NamedTuple):
    words: at.Words
    names: list[str | None]
    indexes: list[Index]


def _window_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of the window of ``length`` words at each place; places too near the end repeat the last words."""
    total = np.zeros(len(hashes), np.uint64)
    last = len(hashes) - 1
    for k, factor in enumerate(at.numbers(length, 211 + length)[: len(hashes)]):
        total[: last + 1 - k] += hashes[k:] * factor
    return at.mix64(total)


def index(items: list[tuple[str | None, str | None]]) -> Benchmark:
    words = at.words(pa.array([text for _, text in items], pa.string()), at.LETTER_OR_DIGIT)
    counts, ends = words.counts(), words.row_ends()
    row = np.repeat(np.arange(len(counts)), counts)
    lengths = np.minimum(counts, WINDOW)
    indexes = []
    for length in sorted(set(lengths.tolist()) - {0}):
        at_place = np.flatnonzero((np.repeat(lengths, counts) == length) & (np.arange(len(row)) + length <= ends))
        h = _window_hashes(words.hashes, length)[at_place]
        order = np.argsort(h, kind="stable")
        bits = np.zeros(1 << _BITS, bool)
        bits[h >> np.uint64(64 - _BITS)] = True
        indexes.append(Index(length, h[order], at_place[order], row[at_place][order], bits))
    return Benchmark(words, [name for name, _ in items], indexes)


def scan(words: at.Words, bench: Benchmark) -> dict[int, tuple[list[tuple[int, int]], set[str]]]:
    """For rows with verified hits: their windows (first word, end; counted within the row) and items."""
    found: dict[int, tuple[list[tuple[int, int]], set[str]]] = {}
    if not len(words.hashes):
        return found
    ends, place = words.row_ends(), np.arange(len(words.hashes))
    for each in bench.indexes:
        h = _window_hashes(words.hashes, each.length)
        maybe = np.flatnonzero(each.bits[h >> np.uint64(64 - _BITS)] & (place + each.length <= ends))
        low = np.searchsorted(each.hashes, h[maybe], "left")
        high = np.searchsorted(each.hashes, h[maybe], "right")
        for start, a, b in zip(maybe[low < high].tolist(), low[low < high].tolist(), high[low < high].tolist()):
            text = words.text(start, start + each.length)
            rows = [
                int(each.rows[k])
                for k in range(a, b)
                if bench.words.text(each.starts[k], each.starts[k] + each.length) == text
            ]
            if rows:
                row = int(np.searchsorted(words.first, start, "right")) - 1
                spans, items = found.setdefault(row, ([], set()))
                first = int(words.first[row])
                spans.append((start - first, start - first + each.length))
                items.update(bench.names[r] for r in rows if bench.names[r] is not None)
    return found


def _merged(spans: Iterable[tuple[int, int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def _parts(benchmark: DataFrame, id_col: str, text_col: str, limit_bytes: int) -> Iterator[Benchmark]:
    """The benchmark's indexes, each over rows whose texts are below the limit together (one driver read each)."""
    rows = pick(benchmark, id=id_col, text=text_col).select(F.col("id").cast("string"), "text")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-2 * size // limit_bytes) if size > limit_bytes else 1
    for part in range(n):
        mine = rows if n == 1 else rows.filter(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == part)
        yield index([(r["id"], r["text"]) for r in mine.collect()])


def _find_batches(
    batches: Iterable[pa.RecordBatch], bench: Broadcast, last: bool, schema: pa.Schema
) -> Iterator[pa.RecordBatch]:
    for batch in at.slices(batches, "text"):
        words = at.words(batch.column("text"), at.LETTER_OR_DIGIT)
        found = scan(words, bench.value)
        spans: list[list[list[int]]] = []
        items: list[list[str]] = []
        earlier = {
            i: (s, t)
            for i, (s, t) in enumerate(zip(batch.column("spans").to_pylist(), batch.column("items").to_pylist()))
            if s or t
        }
        for row in range(batch.num_rows):
            now, names = found.get(row, ((), ()))
            flat, before = earlier.get(row, ((), ()))
            spans.append(_merged([*zip(flat[::2], flat[1::2]), *now]))
            items.append(sorted({*before, *names}))
        if not last:
            flat = [[x for span in each for x in span] for each in spans]
            columns = [batch.column("id"), batch.column("text"), pa.array(flat, pa.list_(pa.int32())), items]
        else:
            hit = [sum(end - start for start, end in each) for each in spans]
            digest = [hashlib.sha256(",".join(each).encode()).hexdigest() for each in items]
            columns = [
                batch.column("id"),
                words.counts(),
                hit,
                [len(each) for each in items],
                digest,
                [n > 0 for n in hit],
            ]
        yield pa.RecordBatch.from_arrays(
            [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
        )


_STATE_SCHEMA = pa.schema(
    [("id", pa.int64()), ("text", pa.string()), ("spans", pa.list_(pa.int32())), ("items", pa.list_(pa.string()))]
)
_FOUND_SCHEMA = pa.schema(
    [
        ("id", pa.int64()),
        ("n_words", pa.int64()),
        ("n_hit", pa.int64()),
        ("n_items", pa.int64()),
        ("items_sha256", pa.string()),
        ("contaminated", pa.bool_()),
    ]
)


def find(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    limit_bytes: int = LIMIT_BYTES,
) -> DataFrame:
    """One row per row of ``docs``: id and what :data:`FOUND` lists."""
    context = docs.sparkSession.sparkContext
    state = pick(docs, id=id_col, text=text_col).select(
        F.col("id").cast("long").alias("id"),
        "text",
        F.array().cast("array<int>").alias("spans"),
        F.array().cast("array<string>").alias("items"),
    )
    parts = list(_shared(context, _parts(benchmark, item_col, item_text_col, limit_bytes)))
    for k, bench in enumerate(parts):
        last = k == len(parts) - 1
        schema = _FOUND_SCHEMA if last else _STATE_SCHEMA
        state = state.mapInArrow(
            lambda batches, b=bench, end=last, s=schema: _find_batches(batches, b, end, s), FOUND if last else _STATE
        )
        if not last:
            state = stage_table(state, "scanned")
    return state


def _shared(context, parts: Iterable[Benchmark]) -> Iterator[Broadcast]:
    for part in parts:
        yield context.broadcast(part)


def _cut(words: at.Words, raw: np.ndarray, row: int, spans: list[list[int]]) -> str:
    """The row's text without its hit words and what stands between them."""
    low, high = int(words.offsets[row]), int(words.offsets[row + 1])
    first = int(words.first[row])
    pieces, at_byte = [], low
    for start, end in spans:
        pieces.append(raw[at_byte : words.starts[first + start]].tobytes())
        at_byte = int(words.ends[first + end - 1])
    pieces.append(raw[at_byte:high].tobytes())
    return b"".join(pieces).decode()


def _remove_batches(batches: Iterable[pa.RecordBatch], bench: Broadcast, column: str) -> Iterator[pa.RecordBatch]:
    for batch in at.slices(batches, column):
        place = batch.schema.get_field_index(column)
        texts = batch.column(place).to_pylist()
        rows, changed = list(range(batch.num_rows)), False
        while rows:  # what a cut joins is looked at again
            part = pa.array([texts[r] for r in rows], pa.string())
            words, (raw, _) = at.words(part, at.LETTER_OR_DIGIT), at.utf8(part)
            found = scan(words, bench.value)
            for k, (spans, _) in found.items():
                texts[rows[k]] = _cut(words, raw, k, _merged(spans))
            changed |= bool(found)
            rows = [rows[k] for k in found]
        yield batch.set_column(place, batch.schema.field(place), pa.array(texts, pa.string())) if changed else batch


def remove_spans(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    limit_bytes: int = LIMIT_BYTES,
) -> DataFrame:
    """``docs`` with every hit passage cut from the text until none is left; all columns keep their place."""
    context = docs.sparkSession.sparkContext
    parts = list(_shared(context, _parts(benchmark, item_col, item_text_col, limit_bytes)))
    names = list(docs.columns)
    plain = docs.toDF(*(f"c{i}" for i in range(len(names))))
    column = f"c{names.index(text_col)}"
    while True:
        cut = plain
        for bench in parts:
            cut = cut.mapInArrow(lambda batches, b=bench: _remove_batches(batches, b, column), cut.schema)
            cut = stage_table(cut, "cut") if len(parts) > 1 else cut
        if len(parts) == 1:
            break
        # With several parts, a later one may join words into a window of an earlier one: go round until nothing changes.
        size = F.sum(F.length(column))
        same = cut.agg(size).first() == plain.agg(size).first()
        plain = cut
        if same:
            break
    return cut.toDF(*names)
