"""Repeated substrings by threshold-bounded interval expansion on a Burrows-Wheeler transform.

Every byte covered by a string of ``THRESHOLD`` bytes that also starts anywhere else is removed.

1. **Anchors.** In each window of 400 bytes the 100-byte string with the smallest hash is an anchor, so equal windows
   have equal anchors at equal places, one in some 150 bytes on random text. The *piece* of an anchor is what lies up to
   300 bytes before and 400 bytes after its start: every window that holds the anchor. Hashes of anchors and pieces are
   counted over all texts. Pieces that occur twice are covered whole; only anchors with different pieces go on, with one
   text per piece.
2. **Expansion.** The pieces of an anchor meet, several anchors to a block. They are cut into cells of eight bytes,
   counted from the anchor, and a cell's symbol is its anchor, place and bytes; so equal symbols never stand for the
   same place of a text. On the transform of the block's symbols, breadth-first backward extension of all intervals
   finds the common prefixes of neighbouring suffixes by increasing length and stops at 49 cells, the least that a
   repeated window has. Neighbours whose common prefix is still unknown then share as much.
3. **Exact ends.** Around such runs of cells the 400-byte windows themselves are compared, at each of the eight offsets
   to the cells, by hashes over their bytes; what they cover is kept per piece.
4. Covered pieces go back to the places of their anchors and the bytes are removed.

An anchor with more than ``GROUP_PIECES`` different pieces (a passage in very many texts) has ranges of its windows
hashed, counted and split by shuffles instead, with combining in the map tasks, so no group is gathered in one task.
The places of a piece that is at very many are dealt to several tasks when they get its covered runs.

Hashes have 64 bits. Copies of a text share its hash and its result; positions are recomputed from texts rather than
shuffled with them. Texts are shuffled twice: where pieces differ, and to their cuts.

Edge cases: a null text is empty; a text below 400 bytes keeps everything; repeated rows are copies of each other; a cut
may fall inside a character, as spans are of bytes; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm import arrow_text as at
from textmill.llm.common import pick
from textmill.storage import stage_table

THRESHOLD = 400
GRAM = 100
BEFORE = THRESHOLD - GRAM
CELL = 8
MIN_CELLS = (THRESHOLD - CELL + 1) // CELL
GROUP_PIECES = 5_000  # of an anchor that meet in a task, 700 bytes each
BLOCK_BYTES = 1 << 19
RANGES = (64, 8, 1)  # windows of a range, round by round; each divides the one before
BROADCAST_ROWS = 1_000_000
HOT_SHARE = 2_000  # a piece at more than one in so many of all places is hot; fewer than this can be
_SEGMENT = 1 << 20  # positions whose hashes are looked at together
FOUND = "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


class Anchors(NamedTuple):
    row: np.ndarray
    start: np.ndarray  # of the anchor, in the slice's bytes
    low: np.ndarray  # of the piece
    high: np.ndarray
    anchor: np.ndarray  # hashes
    piece: np.ndarray


def _sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values."""
    n = len(values) - width + 1
    pad = -len(values) % width
    blocks = np.concatenate([values, np.full(pad, values.max(), values.dtype)]).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(blocks, axis=1).ravel()
    return np.minimum(ahead[:n], behind[width - 1 : width - 1 + n])


def _anchor_starts(hashes: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """Starts of the leftmost smallest string of every window; ``inside`` marks windows within one row."""
    found, width = [], BEFORE + 1
    place_bits = np.uint64(21)
    for low in range(0, len(inside), _SEGMENT):
        part = hashes[low : low + _SEGMENT + width - 1]
        keyed = (part >> place_bits << place_bits) | np.arange(len(part), dtype=np.uint64)
        smallest = _sliding_minimum(keyed, width)[: len(inside) - low]
        smallest = smallest[inside[low : low + len(smallest)]] & np.uint64((1 << 21) - 1)
        if len(smallest):
            fresh = np.concatenate([[True], smallest[1:] != smallest[:-1]])
            found.append(smallest[fresh].astype(np.int64) + low)
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)


def anchors(data: np.ndarray, offsets: np.ndarray) -> Anchors:
    none = np.zeros(0, np.int64)
    n = len(data) - THRESHOLD + 1
    if n <= 0:
        return Anchors(none, none, none, none, none.view(np.uint64), none.view(np.uint64))
    row_end = np.repeat(offsets[1:], np.diff(offsets))
    inside = np.arange(n) + THRESHOLD <= row_end[:n]
    places = np.arange(len(data) - GRAM + 1)
    hashes = at.span_hashes(data, places, places + GRAM)
    start = _anchor_starts(hashes, inside)
    row = np.searchsorted(offsets, start, "right") - 1
    low = np.maximum(start - BEFORE, offsets[row])
    high = np.minimum(start + THRESHOLD, offsets[row + 1])
    piece = at.span_hashes(data, low, high) ^ at.mix64((start - low).astype(np.uint64))
    return Anchors(row, start, low, high, hashes[start], piece)


def _anchor_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in at.slices(batches, "text"):
        data, offsets = at.utf8(batch.column("text"))
        found = anchors(data, offsets)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("t").take(pa.array(found.row)),
                pa.array(found.anchor.view(np.int64)),
                pa.array(found.piece.view(np.int64)),
                pa.array((found.low - offsets[found.row]).astype(np.int64)),
                pa.array((found.high - found.low).astype(np.int32)),
            ],
            names=["t", "anchor", "piece", "low", "length"],
        )


def _piece_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of the wanted pieces (anchor and piece hashes, in turn) of each text."""
    for batch in at.slices(batches, "text"):
        data, offsets = at.utf8(batch.column("text"))
        found = anchors(data, offsets)
        out: dict[tuple[int, int], tuple[int, bytes]] = {}
        wanted = [set(zip(w[::2], w[1::2])) for w in batch.column("wanted").to_pylist()]
        keys = zip(found.anchor.view(np.int64).tolist(), found.piece.view(np.int64).tolist())
        for k, key in enumerate(keys):
            if key in wanted[found.row[k]]:
                left = int(found.start[k] - found.low[k])
                out[key] = (left, data[found.low[k] : found.high[k]].tobytes())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([a for a, _ in out], pa.int64()),
                pa.array([p for _, p in out], pa.int64()),
                pa.array([left for left, _ in out.values()], pa.int32()),
                pa.array([text for _, text in out.values()], pa.binary()),
            ],
            names=["anchor", "piece", "before", "bytes"],
        )


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Starts of the suffixes in their order, by prefix doubling; symbols are below the number of symbols."""
    n = len(symbols)
    rank, step = symbols.astype(np.int64), 1
    while True:
        after = np.zeros(n, np.int64)
        after[: max(n - step, 0)] = rank[step:] + 1
        key = rank * (n + 2) + after
        order = np.argsort(key)
        key = key[order]
        fresh = np.ones(n, bool)
        fresh[1:] = key[1:] != key[:-1]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(fresh) - 1
        if fresh.all():
            return order
        step *= 2


def long_prefixes(symbols: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffix order, for each suffix but the first whether it shares ``least`` symbols with the one before).

    Intervals of the suffix order that begin with a common string are extended by the symbols before them, which the
    transform lists; the interval of the longer string is found through the last-to-first mapping. An interval whose
    right border has no common-prefix length yet gives it the length of the string it came from and is extended in the
    next round; the others are done. Rounds are lengths, so borders that are open after ``least`` rounds are longer.
    """
    n = len(symbols)
    order = suffix_order(symbols)
    transform = symbols[order - 1]  # the symbol before each suffix; the text counts as a circle
    to_first = np.empty(n, np.int64)
    to_first[np.argsort(transform, kind="stable")] = np.arange(n)
    known = np.zeros(n + 1, bool)
    known[[0, n]] = True
    low, high = np.zeros(1, np.int64), np.full(1, n, np.int64)
    for _ in range(least):
        width = high - low
        interval = np.repeat(np.arange(len(low)), width)
        inside = np.arange(len(interval)) - np.repeat(np.cumsum(width) - width, width) + low[interval]
        # Within an interval, equal symbols map to neighbours; so runs of neighbours with one symbol are the extensions.
        mapped = to_first[inside]
        by = np.argsort(interval * n + mapped)
        mapped, interval, symbol = mapped[by], interval[by], transform[inside][by]
        cut = np.ones(len(mapped), bool)
        cut[1:] = (interval[1:] != interval[:-1]) | (symbol[1:] != symbol[:-1])
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], len(mapped))
        new_low, new_high = mapped[starts], mapped[ends - 1] + 1
        open_border = ~known[new_high]
        new_low, new_high = new_low[open_border], new_high[open_border]
        _, one = np.unique(new_high, return_index=True)
        low, high = new_low[one], new_high[one]
        if not len(low):
            break
        known[high] = True
    return order, ~known[1:n]


def covered(pieces: list[bytes], before: list[int], group: list[int]) -> list[np.ndarray]:
    """For each piece, the bytes inside a window that another piece of its group has at the same place."""
    sizes = np.array([len(p) for p in pieces])
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    data = np.frombuffer(b"".join(pieces), np.uint8)
    left, groups = np.array(before), np.array(group)
    cells_before, cells_after = left // CELL, (sizes - left) // CELL
    counts = cells_before + cells_after
    piece = np.repeat(np.arange(len(pieces)), counts)
    place = np.arange(len(piece)) - np.repeat(np.cumsum(counts) - counts, counts) - cells_before[piece]
    begin = offsets[piece] + left[piece] + CELL * place
    value = data[begin[:, None] + np.arange(CELL)].copy().view(np.uint64).ravel()
    value = at.mix64(value) + groups[piece].astype(np.uint64) * at.numbers(2, 307)[0]
    value = at.mix64(value + place.astype(np.int64).view(np.uint64) * at.numbers(2, 307)[1])
    _, number = np.unique(value, return_inverse=True)
    # Each piece ends with a symbol of its own.
    ends = np.cumsum(counts) + np.arange(len(pieces))
    symbols = np.empty(len(piece) + len(pieces), np.int64)
    is_cell = np.ones(len(symbols), bool)
    is_cell[ends] = False
    symbols[is_cell] = number.ravel() + len(pieces)
    symbols[ends] = np.arange(len(pieces))
    cell_of = np.cumsum(is_cell) - 1

    order, long = long_prefixes(symbols, MIN_CELLS)
    run = np.concatenate([[0], np.cumsum(~long)])
    member = np.zeros(len(order), bool)
    member[1:] |= long
    member[:-1] |= long
    cells, run = cell_of[order[member]], run[member]
    out = [np.zeros(size, bool) for size in sizes]
    if not len(cells):
        return out
    owner, first = piece[cells], begin[cells]
    marks = np.zeros(len(data) + 1, np.int32)
    for offset in range(CELL):
        starts = first - offset
        fits = np.flatnonzero((starts >= offsets[owner]) & (starts + THRESHOLD <= offsets[owner + 1]))
        starts = starts[fits]
        key = at.mix64(run[fits].astype(np.uint64)) + at.span_hashes(data, starts, starts + THRESHOLD)
        _, same, times = np.unique(key, return_inverse=True, return_counts=True)
        starts = starts[times[same] > 1]
        np.add.at(marks, starts, 1)
        np.add.at(marks, starts + THRESHOLD, -1)  # windows stay within their piece
    inside = np.cumsum(marks[:-1]) > 0
    return [inside[offsets[k] : offsets[k + 1]] for k in range(len(pieces))]


def _runs(mask: np.ndarray) -> list[int]:
    """Start and end of each run, one after the other."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return edges.tolist()


def _cover_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Covered runs of each piece; rows come sorted by anchor and are handled in blocks of whole anchors."""
    held: list[tuple[int, int, int, bytes]] = []
    size = 0

    def close() -> pa.RecordBatch:
        masks = covered([r[3] for r in held], [r[2] for r in held], np.unique([r[0] for r in held], return_inverse=True)[1].tolist())
        rows = [(r[0], r[1], _runs(m)) for r, m in zip(held, masks) if m.any()]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([r[0] for r in rows], pa.int64()),
                pa.array([r[1] for r in rows], pa.int64()),
                pa.array([r[2] for r in rows], pa.list_(pa.int32())),
            ],
            names=["anchor", "piece", "runs"],
        )

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("anchor", "piece", "before", "bytes")]
        for row in zip(*columns):
            if held and size >= BLOCK_BYTES and row[0] != held[-1][0]:
                yield close()
                held.clear()
                size = 0
            held.append(row)
            size += len(row[3])
    if held:
        yield close()


def _range_batches(batches: Iterable[pa.RecordBatch], parent: int, width: int) -> Iterator[pa.RecordBatch]:
    """Parts of ``width`` windows of the open ranges of each piece: what all windows of a part hold, and its whole.

    A window is named by its start, from 0 for 300 bytes before the anchor to 300. ``hull`` is null where the piece
    doesn't hold all windows of the part.
    """
    for batch in batches:
        owner, lows, cores, hulls, left = [], [], [], [], []
        texts = batch.column("bytes").to_pylist()
        for k, (text, before, opened) in enumerate(
            zip(texts, batch.column("before").to_pylist(), batch.column("lows").to_pylist())
        ):
            low = np.array([x for start in opened for x in range(start, min(start + parent, BEFORE + 1), width)])
            end = np.array([start + parent for start in opened for _ in range(start, min(start + parent, BEFORE + 1), width)])
            high = np.minimum(np.minimum(low + width, end), BEFORE + 1) - 1
            shift = before - BEFORE  # from window numbers to bytes of the piece
            some = (np.maximum(low + shift, 0) <= np.minimum(high + shift, len(text) - THRESHOLD))
            low, high = low[some], high[some]
            data = np.frombuffer(text, np.uint8)
            core = at.span_hashes(data, high + shift, low + shift + THRESHOLD)
            all_in = (low + shift >= 0) & (high + shift + THRESHOLD <= len(text))
            a, b = np.where(all_in, low + shift, 0), np.where(all_in, high + shift + THRESHOLD, 0)
            hull = at.span_hashes(data, a, b).view(np.int64).tolist()
            owner += [k] * len(low)
            lows += low.tolist()
            cores += core.view(np.int64).tolist()
            hulls += [h if whole else None for h, whole in zip(hull, all_in.tolist())]
            left += [(int(x) + shift, int(y) + shift + THRESHOLD) for x, y in zip(low, high)]
        take = pa.array(owner, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("anchor").take(take),
                batch.column("piece").take(take),
                pa.array(lows, pa.int32()),
                pa.array(cores, pa.int64()),
                pa.array(hulls, pa.int64()),
                pa.array([list(x) for x in left], pa.list_(pa.int32())),
            ],
            names=["anchor", "piece", "low", "core", "hull", "run"],
        )


def _covered_by_ranges(pieces: DataFrame) -> DataFrame:
    """Covered runs of pieces of anchors that have very many, by counting ever smaller ranges of windows.

    If what all windows of a range share occurs once, none of them is repeated; if the range's whole occurs twice, all
    are. Other ranges are split, so a piece keeps a few open ranges, where repeated text ends.
    """
    pieces = stage_table(pieces, "many-pieces")
    opened = pieces.select("anchor", "piece", F.array(F.lit(0)).alias("lows"))
    found, parent = [], BEFORE + 1
    for width in RANGES:
        ranges = pieces.join(opened, ["anchor", "piece"]).mapInArrow(
            lambda batches, p=parent, w=width: _range_batches(batches, p, w),
            "anchor long, piece long, low int, core long, hull long, run array<int>",
        )
        ranges = stage_table(ranges, "ranges")
        shared = ranges.groupBy("anchor", "low", "core").agg(
            F.count(F.lit(1)).alias("n"), (F.min("hull") != F.max("hull")).alias("unlike"), F.count("hull").alias("whole")
        )
        shared = shared.filter("n > 1").select("anchor", "low", "core", F.expr("unlike or whole < n").alias("mixed"))
        alive = stage_table(ranges.join(shared, ["anchor", "low", "core"]), "ranges")
        if width > 1:
            twice = alive.groupBy("anchor", "low", "hull").agg(F.count(F.lit(1)).alias("n"), F.min("piece").alias("first"))
            twice = twice.filter("n > 1 and hull is not null")
            alive = stage_table(alive.join(twice, ["anchor", "low", "hull"], "left"), "ranges")
            # One piece of each closed range stays open for those that share a part of it only.
            still = alive.filter("n is null or (mixed and piece = first)")
            opened = still.groupBy("anchor", "piece").agg(F.collect_list("low").alias("lows"))
            alive = alive.filter("n is not null")  # of a single window, the shared part is the whole
        found.append(alive.groupBy("anchor", "piece").agg(F.flatten(F.collect_list("run")).alias("runs")))
        parent = width
    return reduce(DataFrame.unionByName, found)


def _cut_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in at.slices(batches, "text"):
        data, offsets = at.utf8(batch.column("text"))
        cuts = batch.column("cuts").fill_null(pa.scalar([], batch.column("cuts").type))
        values = cuts.flatten().to_numpy(zero_copy_only=False)
        base = np.repeat(offsets[:-1], np.diff(cuts.offsets.to_numpy()))
        marks = np.zeros(len(data) + 1, np.int32)
        np.add.at(marks, (values + base)[::2], 1)
        np.add.at(marks, (values + base)[1::2], -1)
        gone = np.cumsum(marks[:-1]) > 0
        # A span begins where a byte goes and the one before stays or belongs to another text.
        begins = gone.copy()
        begins[1:] &= ~gone[:-1]
        heads = offsets[:-1][offsets[:-1] < len(data)]
        begins[heads] = gone[heads]
        removed, spans = (np.diff(np.concatenate([[0], np.cumsum(x)])[offsets]) for x in (gone, begins))
        digests = []
        for k in range(batch.num_rows):
            text = data[offsets[k] : offsets[k + 1]]
            text = text[~gone[offsets[k] : offsets[k + 1]]] if removed[k] else text
            digests.append(hashlib.sha256(text.tobytes()).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("id"),
                pa.array(np.diff(offsets), pa.int64()),
                pa.array(removed, pa.int64()),
                pa.array(spans, pa.int64()),
                pa.array(digests, pa.string()),
            ],
            names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def _some(texts: DataFrame, keys: DataFrame, how: str) -> DataFrame | None:
    """``texts`` joined with the text hashes ``keys`` by broadcast, None if they are too many (8 bytes each)."""
    return texts.join(F.broadcast(keys), "t", how) if keys.count() <= BROADCAST_ROWS else None


def _with_runs(places: DataFrame, runs: DataFrame, pieces: DataFrame) -> DataFrame:
    """``places`` with the ``runs`` of their pieces, inner join. ``pieces`` has the number of places ``n`` of each.

    The places of a hot piece are dealt to so many tasks that none gets more than one in ``HOT_SHARE`` of all places,
    and its runs are repeated as often. Hot pieces are fewer than ``HOT_SHARE`` and their runs are repeated less than
    twice that often in all, at any size.
    """
    key = ["anchor", "piece"]
    total = max(pieces.agg(F.sum("n")).first()[0] or 0, 1)
    share = F.least("n", F.ceil(F.col("n") * HOT_SHARE / total)).alias("_tasks")
    hot = F.broadcast(pieces.filter(F.col("n") * HOT_SHARE > total).select(*key, share))
    tasks = F.coalesce("_tasks", F.lit(1).cast("long"))
    places = places.join(hot, key, "left").withColumn("_salt", F.pmod(F.xxhash64("t"), tasks)).drop("_tasks")
    dealt = F.explode(F.sequence(F.lit(0).cast("long"), tasks - 1))
    runs = runs.join(hot, key, "left").withColumn("_salt", dealt).drop("_tasks")
    return places.join(runs, [*key, "_salt"]).drop("_salt")


def repeated_spans(docs: DataFrame, text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(texts with their hash ``t``, per text hash the runs of bytes to remove: ``cuts`` array of start, end, ...)."""
    texts = docs.select(F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")).withColumn("t", F.xxhash64("text"))
    placed = texts.mapInArrow(_anchor_batches, "t long, anchor long, piece long, low long, length int")
    placed = stage_table(placed, "anchors")
    pieces = placed.groupBy("anchor", "piece").agg(F.count(F.lit(1)).alias("n"), F.min("t").alias("t"))
    several = pieces.groupBy("anchor").agg(F.count(F.lit(1)).alias("different"), F.sum("n").alias("all"))
    several = several.filter("all > 1").select("anchor", "different")
    common = stage_table(pieces.join(several, "anchor"), "common")

    unlike = common.filter("different > 1")
    wanted = unlike.groupBy("t").agg(F.flatten(F.collect_list(F.array("anchor", "piece"))).alias("wanted"))
    wanted = stage_table(wanted, "wanted")
    some = _some(texts, wanted.select("t"), "left_semi")
    sources = (texts if some is None else some).join(wanted, "t").dropDuplicates(["t"]).select("text", "wanted")
    parts = sources.mapInArrow(_piece_batches, "anchor long, piece long, before int, bytes binary")
    parts = stage_table(parts, "piece-bytes")
    many = unlike.filter(F.col("different") > GROUP_PIECES).select("anchor").distinct()
    few = parts.join(many, "anchor", "left_anti")
    few = few.repartition("anchor").sortWithinPartitions("anchor", "piece")
    runs = few.mapInArrow(_cover_batches, "anchor long, piece long, runs array<int>")
    runs = runs.unionByName(_covered_by_ranges(parts.join(many, "anchor", "left_semi")))
    whole = common.filter("n > 1").select("anchor", "piece", F.lit(None).cast("array<int>").alias("runs"))
    runs = stage_table(runs.unionByName(whole), "covered")
    # A piece that occurs twice is covered whole, whatever the comparison found.
    runs = runs.groupBy("anchor", "piece").agg(
        F.flatten(F.collect_list("runs")).alias("runs"), F.count_if(F.col("runs").isNull()).alias("whole")
    )
    # Copies of a text have the same anchors, which are looked up once.
    once = placed.select("t", "anchor", "piece", "low", "length").distinct()
    back = _with_runs(once, runs, common)
    whole_run = F.when(F.col("length") >= THRESHOLD, F.array(F.lit(0), F.col("length")))
    whole_run = whole_run.otherwise(F.array().cast("array<int>"))
    each = F.when(F.col("whole") > 0, whole_run).otherwise(F.col("runs"))
    cut = F.transform(each, lambda x: x.cast("long") + F.col("low"))
    cuts = back.select("t", cut.alias("cut")).filter(F.size("cut") > 0)
    cuts = cuts.groupBy("t").agg(F.flatten(F.collect_list("cut")).alias("cuts"))
    return texts, stage_table(cuts, "cuts")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_bytes, n_removed, n_spans, kept_sha256 (of the bytes that remain)."""
    picked = pick(docs, id=id_col, text=text_col).select(
        F.col("id").cast("long").alias("id"), F.coalesce("text", F.lit("")).alias("text")
    )
    _, cuts = repeated_spans(picked)
    hashed, keys = picked.withColumn("t", F.xxhash64("text")), cuts.select("t")
    touched = _some(hashed, keys, "left_semi")
    if touched is None:
        joined = hashed.join(cuts, "t", "left")
    else:
        rest = _some(hashed, keys, "left_anti").withColumn("cuts", F.lit(None).cast("array<long>"))
        joined = touched.join(cuts, "t").unionByName(rest)
    return joined.select("id", "text", "cuts").mapInArrow(_cut_batches, FOUND)
