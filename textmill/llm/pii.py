"""Personal data: fixed patterns and a character tagger (:mod:`textmill.llm.tagger`).

Patterns find emails, IP addresses, card and phone numbers over the whole text. A bidirectional LSTM with CRF
transitions, trained on the driver in numpy, adds spans the patterns miss (a phone number without ``+``, say). Its
labelled spans are what the patterns find in at most ``TRAIN_ROWS`` windows of the documents, the ones with the smallest
hashes, and ``TRAIN_MADE`` made examples of forms the patterns don't cover, with look-alikes that are none.

A text is cut into windows that overlap by half. Each character takes its label from the window in which it is farthest
from an edge, labels are joined to spans over the whole text, and a span counts if it holds a mark (a digit, an at sign
or one spelled out), the tagger is sure of all of it and no pattern touches it. Marks are looked for in the whole text.
Windows are decoded where a mark is and from there on as far as a span goes, so a span has any length; the result is
that of decoding all windows.

The documents are not shuffled; the model (some 20 kB) is broadcast.

Edge cases: a null or empty text has no spans; repeated rows are searched one by one; with an empty table or one without
digits the tagger is trained on made examples alone; other columns are ignored by :func:`find` and kept by :func:`mask`.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm import arrow_text as at
from textmill.llm import tagger
from textmill.llm.common import pick

KINDS = ("email", "ip", "card", "phone")
TRAIN_ROWS = 1_500
TRAIN_MADE = 1_500
EPOCHS = 8
WINDOW = 96
SURE = 0.9
SEED = 5
_WIDTH, _HIDDEN = 10, 20
_FOUND = "id long, base array<string>, spans array<string>"

_AT_NAME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_AT_HOST = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_MARK = re.compile(r"[\d@\uFF20\uFE6B]|[\[({]\s?(?i:at|dot)\s?[\])}]")  # digits and at signs of any script, and spelled-out signs

Span = tuple[str, int, int]


def emails(text: str) -> Iterator[Span]:
    """Leftmost matches of name@host: the name goes back from each at sign, at most to the match before."""
    done, sign = 0, text.find("@")
    while sign >= 0:
        start = sign
        while start > done and text[start - 1] in _AT_NAME:
            start -= 1
        host = _AT_HOST.match(text, sign) if start < sign else None
        if host:
            yield "email", start, host.end()
            done = host.end()
        sign = text.find("@", max(sign + 1, done))


def luhn(digits: str) -> bool:
    doubled = [int(d) * 2 for d in digits[-2::-2]]
    return (sum(map(int, digits[::-2])) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def base_spans(text: str) -> list[Span]:
    """What the patterns find, by kind and start."""
    if not _MARK.search(text):
        return []
    found = list(emails(text))
    for m in _IP.finditer(text):  # a match always begins where a run of digits does
        if all(len(part) <= 3 and int(part or 0) <= 255 for part in (p.lstrip("0") for p in m.group().split("."))):
            found.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
            found.append(("phone", *m.span()))
    return found


# Symbols: some signs for themselves, everything else by class. 0 pads.
_SIGNS = "@.-+()_%:=/,\"' \n"
_SYMBOLS = np.full(128, 1, np.int64)
for _i, _c in enumerate(_SIGNS):
    _SYMBOLS[ord(_c)] = 6 + _i
for _low, _high, _class in ((48, 58, 2), (65, 91, 3), (97, 123, 4)):
    _SYMBOLS[_low:_high] = _class
_N_SYMBOLS = 6 + len(_SIGNS)
_N_LABELS = 1 + 2 * len(KINDS)


def symbols(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(codes < 128, _SYMBOLS[np.minimum(codes, 127)], 5)


def _labels(text: str, spans: Iterable[Span]) -> np.ndarray:
    """0 outside, then a begin and an inside label for each kind."""
    out = np.zeros(len(text), np.int64)
    for kind, start, end in spans:
        label = 1 + 2 * KINDS.index(kind)
        out[start:end] = label + 1
        out[start] = label
    return out


_WIDE = {48 + k: 0xFF10 + k for k in range(10)}  # full-width digits


def made_examples(n: int, seed: int) -> list[tuple[str, list[Span]]]:
    """Invented windows: words around one item, which is a span of some kind or a look-alike of none."""
    rng = np.random.default_rng(seed)
    digits = lambda k: "".join(map(str, rng.integers(0, 10, k)))
    letters = lambda k: "".join(map(chr, rng.integers(97, 123, k)))
    chooser = lambda options: options[int(rng.integers(len(options)))]
    items = (
        ("phone", lambda: f"({digits(3)}) {digits(3)}-{digits(4)}"),
        ("phone", lambda: f"{digits(3)}-{digits(3)}-{digits(4)}"),
        ("phone", lambda: f"+{digits(1)} ({digits(3)}) {digits(3)}-{digits(4)}"),
        ("phone", lambda: f"+{digits(2)} {digits(3)} {digits(7)}"),
        ("email", lambda: f"{letters(5)}.{letters(4)}@{letters(6)}.com"),
        ("email", lambda: f"{letters(4)}{digits(2)}@{letters(4)}{digits(1)}.example.org"),
        ("email", lambda: f"{letters(5)} [at] {letters(6)} [dot] com"),
        ("phone", lambda: f"+{digits(2)} {digits(3)} {digits(4)}".translate(_WIDE)),
        ("card", lambda: " ".join(digits(4) for _ in range(4))),
        ("card", lambda: "-".join(digits(4) for _ in range(4))),
        ("ip", lambda: ".".join(str(rng.integers(1, 255)) for _ in range(4))),
        (None, lambda: f"{digits(4)}-{digits(2)}-{digits(2)}"),
        (None, lambda: f"{digits(2)}:{digits(2)}"),
        (None, lambda: f"{digits(1)}.{digits(1)}"),
        (None, lambda: f"{digits(1)}.{digits(1)}.{digits(2)}"),
        (None, lambda: f"{digits(4)}"),
        (None, lambda: f"{digits(2)}"),
        (None, lambda: f"{digits(3)},{digits(3)}.{digits(2)}"),
        (None, lambda: f"@{letters(7)}"),
        (None, lambda: f"{letters(8)}={digits(3)}{letters(2)}{digits(6)}{letters(1)}{digits(4)}"),
        (None, lambda: f'"{digits(5)}{letters(3)}{digits(12)}{letters(2)}{digits(9)}"'),
        (None, lambda: f"{letters(4).upper()}{digits(2)}{letters(6).upper()}{digits(1)}{letters(3).upper()}"),
        (None, lambda: f"{digits(int(rng.integers(5, 12)))}"),
        (None, lambda: f"{digits(int(rng.integers(20, 40)))}"),
    )
    out = []
    for _ in range(n):
        kind, make = chooser(items)
        before = " ".join(letters(int(rng.integers(1, 9))) for _ in range(int(rng.integers(0, 9))))
        after = " ".join(letters(int(rng.integers(1, 9))) for _ in range(int(rng.integers(0, 9))))
        before, after = before + " " * bool(before), chooser((" ", ". ", ", ", "\n")) + after
        item = make()
        span = [(kind, len(before), len(before) + len(item))] if kind else []
        out.append((before + item + after, span))
    return out


def _training_windows(examples: Iterable[tuple[str, list[Span]]]) -> tuple[np.ndarray, np.ndarray]:
    x, y = [], []
    for text, spans in examples:
        row, labels = np.zeros(WINDOW, np.int64), np.zeros(WINDOW, np.int64)
        row[: len(text)] = symbols(text)[:WINDOW]
        labels[: len(text)] = _labels(text, spans)[:WINDOW]
        x.append(row)
        y.append(labels)
    return np.stack(x), np.stack(y)


def fit(texts: DataFrame, rows: int = TRAIN_ROWS, made: int = TRAIN_MADE, epochs: int = EPOCHS) -> tagger.Parameters:
    """Train the tagger on at most ``rows`` windows of ``texts`` (column text) and ``made`` invented ones.

    Of each document with a digit or at sign two windows may be drawn, so a document adds a few hundred bytes. A window
    starts and ends at blanks, which keeps spans whole.
    """
    around = r"(?s)(?<=\s)(?:\S{1,40}\s){0,4}\S{0,40}[0-9@]\S{0,40}(?:\s\S{1,40}){0,4}(?=\s)"
    marked = texts.filter(F.col("text").rlike("[0-9@]"))
    drawn = (
        marked.select(F.explode(F.slice(F.regexp_extract_all("text", F.lit(around), F.lit(0)), 1, 2)).alias("window"))
        .filter(F.length("window") <= WINDOW)
        .orderBy(F.xxhash64("window"), "window")
        .limit(rows)
        .collect()
    )
    examples = [(r["window"], base_spans(r["window"])) for r in drawn] + made_examples(made, SEED)
    x, y = _training_windows(examples)
    return tagger.train(x, y, (_N_SYMBOLS, _N_LABELS, _WIDTH, _HIDDEN), epochs, seed=SEED)


_HALF, _QUARTER = WINDOW // 2, WINDOW // 4


def _last_window(size: int) -> int:
    """Windows of a text begin at 0, half a window, ...; the last is the first that reaches its end."""
    return max(-((WINDOW - size) // _HALF), 0)


def _window_of(place: int, size: int) -> int:
    """The window in which ``place`` is farthest from an edge; edges of the text are none."""
    return min(max((place - _QUARTER) // _HALF, 0), _last_window(size))


def _window_starts(text: str) -> list[int]:
    """Starts of the windows that decide the places of marks."""
    return sorted({_window_of(m.start(), len(text)) * _HALF for m in _MARK.finditer(text)})


def _decide(model: tagger.Parameters, ids: dict[int, np.ndarray], jobs: list[tuple[int, int]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each window (text, number) the labels of the places it decides and their marginal probabilities."""
    for low in range(0, len(jobs), 1024):
        part = jobs[low : low + 1024]
        rows = np.zeros((len(part), WINDOW), np.int64)
        for row, (i, k) in zip(rows, part):
            window = ids[i][k * _HALF : k * _HALF + WINDOW]
            row[: len(window)] = window
        for (i, k), labels, trust in zip(part, *tagger.decode(model, rows)):
            size = len(ids[i])
            own = slice(_QUARTER if k else 0, size - k * _HALF if k == _last_window(size) else WINDOW - _QUARTER)
            yield labels[own].astype(np.uint8), trust[own].astype(np.float32)


Decided = dict[int, tuple[np.ndarray, np.ndarray]]


def _read_labels(decided: Decided, marks: np.ndarray, size: int, sure: float) -> tuple[list[Span], set[int]]:
    """Spans that hold a mark, by the windows decided so far, and the windows that may change them."""
    spans, missing = [], set()
    numbers = sorted(decided)
    for first in (k for k in numbers if k - 1 not in decided):
        stop = first
        while stop in decided:
            stop += 1
        labels, trust = (np.concatenate(x) for x in zip(*(decided[k] for k in range(first, stop))))
        base = first * _HALF + _QUARTER if first else 0
        kinds = (labels + 1) // 2  # 0 is none
        cuts = np.flatnonzero((kinds[1:] != kinds[:-1]) | (labels[1:] % 2 == 1)) + 1
        edges = np.concatenate([[0], cuts, [len(labels)]])
        for begin, end in zip(edges[:-1].tolist(), edges[1:].tolist()):
            held = np.searchsorted(marks, base + end) > np.searchsorted(marks, base + begin)
            if not kinds[begin] or not held or trust[begin:end].min() < sure:
                continue
            begun = labels[begin] % 2 == 1
            if not begun and (begin or not first):
                continue  # the inside of nothing
            if not begun:
                missing.add(first - 1)
            if end == len(labels) and base + end < size:
                missing.add(stop)
            spans.append((KINDS[kinds[begin] - 1], base + begin, base + end))
    return spans, missing


def added_spans(model: tagger.Parameters, texts: list[str], sure: float = SURE) -> list[list[Span]]:
    """What the tagger finds in each text: spans that hold a mark, as if all its windows were decided.

    The windows of the marks are decided first, then, as long as there are any, the windows into which such a span may
    reach; the others hold no part of one.
    """
    out: list[list[Span]] = [[] for _ in texts]
    marks = {i: np.array([m.start() for m in _MARK.finditer(text)]) for i, text in enumerate(texts)}
    marks = {i: places for i, places in marks.items() if len(places)}
    ids = {i: symbols(texts[i]) for i in marks}
    decided: dict[int, Decided] = {i: {} for i in marks}
    jobs = [(i, start // _HALF) for i in marks for start in _window_starts(texts[i])]
    while jobs:
        for (i, k), labels in zip(jobs, _decide(model, ids, jobs)):
            decided[i][k] = labels
        changed, jobs = dict.fromkeys(i for i, _ in jobs), []
        for i in changed:
            out[i], missing = _read_labels(decided[i], marks[i], len(ids[i]), sure)
            jobs += [(i, k) for k in sorted(missing)]
    return out


def all_spans(model: tagger.Parameters, texts: list[str]) -> list[tuple[list[Span], list[Span]]]:
    """For each text the pattern spans and, by kind and start, these with the tagger's that none of them touches."""
    base = [base_spans(text) for text in texts]
    out = []
    for own, extra in zip(base, added_spans(model, texts)):
        clear = [s for s in extra if all(s[2] <= b[1] or s[1] >= b[2] for b in own)]
        merged = sorted([*own, *clear], key=lambda s: (KINDS.index(s[0]), s[1]))
        out.append((own, merged))
    return out


def _written(spans: list[Span]) -> list[str]:
    return [f"{kind}:{start}:{end}" for kind, start, end in spans]


def _find_batches(batches: Iterable[pa.RecordBatch], model: Broadcast) -> Iterator[pa.RecordBatch]:
    kinds = pa.list_(pa.string())
    for batch in at.slices(batches, "text"):
        texts = [text or "" for text in batch.column("text").to_pylist()]
        found = all_spans(model.value, texts)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("id"),
                pa.array([_written(base) for base, _ in found], kinds),
                pa.array([_written(spans) for _, spans in found], kinds),
            ],
            names=["id", "base", "spans"],
        )


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, base and all spans, each as kind:start:end in code points, by kind and start."""
    texts = pick(docs, id=id_col, text=text_col).withColumn("id", F.col("id").cast("long"))
    model = docs.sparkSession.sparkContext.broadcast(fit(texts))
    return texts.mapInArrow(lambda batches: _find_batches(batches, model), _FOUND)


def masked(text: str, spans: list[Span]) -> str:
    """``text`` with each span replaced by its kind in brackets; what overlaps is replaced as one."""
    out, done = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= done:
            out += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join([*out, text[done:]])


def _mask_batches(batches: Iterable[pa.RecordBatch], model: Broadcast, column: str) -> Iterator[pa.RecordBatch]:
    for batch in at.slices(batches, column):
        place = batch.schema.get_field_index(column)
        texts = batch.column(place).to_pylist()
        found = all_spans(model.value, [text or "" for text in texts])
        texts = [text if text is None else masked(text, spans) for text, (_, spans) in zip(texts, found)]
        yield batch.set_column(place, batch.schema.field(place), pa.array(texts, pa.string()))


def mask(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with personal data in the text replaced by its kind; all columns keep their place."""
    names = list(docs.columns)
    plain = docs.toDF(*(f"c{i}" for i in range(len(names))))
    column = f"c{names.index(text_col)}"
    model = docs.sparkSession.sparkContext.broadcast(fit(plain.select(F.col(column).alias("text"))))
    return plain.mapInArrow(lambda batches: _mask_batches(batches, model, column), plain.schema).toDF(*names)
