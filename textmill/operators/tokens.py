"""Analysers: text to tokens, at three granularities (A finest, C longest units).

Everything downstream depends only on surfaces, normalized forms and rule flags, so a morphological analyser is a
plug-in (:class:`PythonAnalyser`). Counting and lookups handle *units*, the smallest value that determines a token's
forms: the surface alone where the normalized form follows from it, else both. :class:`ScriptRunAnalyser` is the
built-in stand-in: runs of one script become tokens and their endings decide the word class, in column expressions and, for
sentences and units, in Arrow batches (``operators.runs``).
"""

from __future__ import annotations

import logging
import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.functions.chars import (
    DIGIT,
    EMOJI,
    HALF_WIDTH_KATAKANA,
    HIRAGANA,
    JAPANESE,
    KANJI,
    LATIN,
    LINE_BREAKS,
    WHITESPACE_CHARS,
    flatten_line_breaks,
    has_line_breaks,
    starts_with_emoji,
)
from textmill.operators import runs

MODES = ("A", "B", "C")

# Names of the tag set and surfaces that the sentence rules look for.
SYMBOL, BLANK, PARTICLE = "補助記号", "空白", "助詞"
VERB, ADJECTIVE, AUXILIARY = "動詞", "形容詞", "助動詞"
FULL_STOP, COMMA = "句点", "読点"
CONCLUSIVE, CONTINUATIVE = "終止形", "連用形"
QUOTE_OPEN = ("「", "｢")
QUOTE_CLOSE = ("」", "｣")
COMMA_SURFACES = ("、", ",")
CUT_OFF_PARTICLES = ("が", "と", "に", "を", "は", "も")
CUT_OFF_MARKS = ("‥", "・")
MARKUP = ("[[", "]]")


class Tags(NamedTuple):
    word_class: str
    sub_class: str = "一般"
    conjugation: str = "*"


class Flag:
    """What the sentence rules need to know about a token, as bits: an array of integers is all they carry along."""

    STOP = 1  # full stop
    PAUSE = 2  # symbol or blank: ends a sentence after a conclusive form
    EMOJI = 4  # ends a sentence after a predicate
    CONCLUSIVE = 8
    PREDICATE = 16
    QUOTE_OPEN = 32
    QUOTE_CLOSE = 64
    FILLER = 128  # not a word: skipped when looking for the last word
    COMMA = 256
    CUT_OFF_PARTICLE = 512
    CONTINUATIVE = 1024
    CUT_OFF_MARK = 2048


_EMOJI_START = re.compile("[" + re.sub(r"\\x\{(\w+)\}", lambda m: chr(int(m[1], 16)), EMOJI) + "]")


def rule_flags(surface: str, tags: Tags) -> int:
    flags = _tag_flags(*tags)
    if _EMOJI_START.match(surface):
        flags |= Flag.EMOJI
    if len(surface) == 1:
        flags |= _ALONE.get(surface, 0)
        if tags.word_class == PARTICLE and surface in CUT_OFF_PARTICLES:
            flags |= Flag.CUT_OFF_PARTICLE
    return flags


@lru_cache(1 << 12)
def _tag_flags(word_class: str, sub_class: str, conjugation: str) -> int:
    tests = (
        (Flag.STOP, FULL_STOP in sub_class),
        (Flag.PAUSE, SYMBOL in word_class or BLANK in word_class),
        (Flag.CONCLUSIVE, CONCLUSIVE in conjugation),
        (Flag.PREDICATE, word_class in (VERB, ADJECTIVE, AUXILIARY)),
        (Flag.FILLER, word_class in (SYMBOL, BLANK)),
        (Flag.COMMA, COMMA in sub_class),
        (Flag.CONTINUATIVE, CONTINUATIVE in conjugation),
    )
    return sum(bit for bit, holds in tests if holds)


# Surfaces of one character that the rules look for.
_ALONE = {
    **dict.fromkeys(QUOTE_OPEN, Flag.QUOTE_OPEN),
    **dict.fromkeys(QUOTE_CLOSE, Flag.QUOTE_CLOSE),
    **dict.fromkeys(COMMA_SURFACES, Flag.COMMA),
    **dict.fromkeys(CUT_OFF_MARKS, Flag.CUT_OFF_MARK),
}


class ScriptRunAnalyser:
    """Script runs as tokens, in column expressions only. Joining the surfaces rebuilds the text.

    Mode C keeps a kanji run together with the hiragana that follows it, mode B cuts between scripts, and mode A also
    cuts kanji and digits into single characters.
    """

    max_line_bytes = None

    # The middle dot lies in the katakana block but separates words.
    KATAKANA_RUN = r"[\x{30A0}-\x{30FA}\x{30FC}-\x{30FF}]+"
    PATTERNS = {
        "A": rf"[{HIRAGANA}]+|{KATAKANA_RUN}|[{HALF_WIDTH_KATAKANA}]+|[{LATIN}]+|(?s:.)",
        "B": rf"[{KANJI}]+|[{HIRAGANA}]+|{KATAKANA_RUN}|[{HALF_WIDTH_KATAKANA}]+|[{LATIN}]+|[{DIGIT}]+|(?s:.)",
        "C": rf"[{KANJI}]+[{HIRAGANA}]*|[{HIRAGANA}]+|{KATAKANA_RUN}|[{HALF_WIDTH_KATAKANA}]+"
        rf"|[{LATIN}]+|[{DIGIT}]+|(?s:.)",
    }

    STOPS = "。．.！!？?"
    COMMAS = "、，,"
    SYMBOLS = "…『』（）()［］[]【】＜＞<>：:；;-*#%&|$\"'/\\^~=+@_`{}"
    PARTICLES = "がとにをはも"
    OTHER_PARTICLES = "のでへ"
    AUXILIARIES = ("た", "だ", "です", "ます", "ない")
    CONCLUSIVE_ENDINGS = "うくぐすつぬぶむる"
    CONTINUATIVE_ENDINGS = "きぎしちてにびみり"
    ADJECTIVE_ENDINGS = "い"

    # Full-width letters and digits fold to ASCII, upper case to lower, katakana to hiragana.
    FOLD_FROM = (
        "".join(chr(c) for c in range(ord("A"), ord("Z") + 1))
        + "".join(chr(c) for c in range(0xFF21, 0xFF3B))
        + "".join(chr(c) for c in range(0xFF41, 0xFF5B))
        + "".join(chr(c) for c in range(0xFF10, 0xFF1A))
        + "".join(chr(c) for c in range(0x30A1, 0x30F7))
    )
    FOLD_TO = (
        "abcdefghijklmnopqrstuvwxyz" * 3
        + "0123456789"
        + "".join(chr(c) for c in range(0x3041, 0x3097))
    )

    def surfaces(self, text: Column, mode: str = "C") -> Column:
        return F.regexp_extract_all(text, F.lit(self.PATTERNS[mode]), F.lit(0))

    def pieces(self, line: Column, chars: int) -> Column:
        """``line`` in pieces of ``chars`` characters, each up to the end of the token it would cut."""
        runs = (f"[{HIRAGANA}]", self.KATAKANA_RUN[:-1], f"[{HALF_WIDTH_KATAKANA}]", f"[{LATIN}]", f"[{DIGIT}]")
        rest = "|".join([rf"(?<=[{KANJI}])[{KANJI}]*+[{HIRAGANA}]*+", *(f"(?<={run}){run}*+" for run in runs)])
        return F.regexp_extract_all(line, F.lit(rf"(?s).{{1,{chars}}}(?:{rest}|)"), F.lit(0))

    def normalize(self, surface: Column) -> Column:
        return F.translate(surface, self.FOLD_FROM, self.FOLD_TO)

    def units(self, text: Column, mode: str = "C", flat: bool = False) -> Column:
        """Array of surfaces; with ``flat``, line breaks inside them are spaces, which are tokens of their own as well.

        Flat ones, which are counted, are found in Arrow batches. Lookups keep the column function: behind a batch the joins
        of a lookup were planned with a shuffle.
        """
        if not flat:
            return self.surfaces(text, mode)

        def found(texts: pa.Array) -> pa.Array:
            kinds, parts, sizes = _kinds_of_mode(type(self), mode), [], []
            for part in runs.steps(texts):
                tokens, firsts = runs.find_tokens(part, kinds, mode == "C")
                parts.append(tokens)
                sizes.append(np.diff(firsts))
            return _lists_of_known(pa.concat_arrays(parts) if parts else pa.array([], pa.string()), sizes, texts)

        text = F.when(has_line_breaks(text), flatten_line_breaks(text)).otherwise(text)
        return runs.by_batch(found, T.ArrayType(T.StringType()))(text)

    def counted_units(self, texts: DataFrame, by: Iterable[str], text_col: str, modes=MODES) -> DataFrame:
        """``by``, unit and a count per mode (``cnt_a``, ...) of the flat units of ``texts``, to be added up: a unit has a row
        for each task and so many units before it.

        Units are counted where they are found, so neither a worker nor an executor holds the arrays of a batch of texts.
        """
        analyser, by = type(self), list(by)
        counts = [f"cnt_{mode.lower()}" for mode in modes]
        fields = [texts.schema[name] for name in by] + [T.StructField("unit", T.StringType())]
        schema = T.StructType([*fields, *(T.StructField(name, T.LongType()) for name in counts)])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[tuple, list[pa.Table]] = {}
            for batch in batches:
                group = _numbers_of(batch, by)
                for number in np.unique(group):
                    rows = np.flatnonzero(group == number)
                    key = tuple(batch.column(name)[int(rows[0])] for name in by)
                    known = held.setdefault(key, [])
                    whole = len(rows) == batch.num_rows
                    for part in runs.steps(batch.column(text_col) if whole else batch.column(text_col).take(pa.array(rows))):
                        known += _counts_of(part, analyser, modes, counts)
                        if sum(table.nbytes for table in known) > HELD_BYTES:
                            known[:] = [_added(known, counts)]
                            if known[0].nbytes > HELD_BYTES // 2:
                                yield from _counted_batches(key, known.pop(), schema)
            for key, known in held.items():
                if known:
                    yield from _counted_batches(key, _added(known, counts), schema)

        text = F.col(text_col)
        flat = F.when(has_line_breaks(text), flatten_line_breaks(text)).otherwise(text)
        return texts.select(*by, flat.alias(text_col)).mapInArrow(run, schema)

    def surface(self, unit: Column) -> Column:
        return unit

    def normalized(self, unit: Column) -> Column:
        return self.normalize(unit)

    def tokens(self, text: Column, mode: str = "C") -> Column:
        return F.transform(self.found_tokens(text, mode), lambda token: F.struct(*self.token_fields(token)))

    def found_tokens(self, text: Column, mode: str = "C") -> Column:
        """Array of (surface, normalized, kind) per token, found in Arrow batches; :meth:`token_fields` tells its tags."""

        def found(texts: pa.Array) -> pa.Array:
            parts, sizes = [], []
            for part in runs.steps(texts):
                tokens, firsts = _tagged_tokens(type(self), part, mode)
                parts.append(tokens)
                sizes.append(np.diff(firsts))
            values = pa.concat_arrays(parts) if parts else pa.array([], pa.struct(_FOUND_FIELDS))
            return _lists_of_known(values, sizes, texts)

        return runs.by_batch(found, FOUND)(text)

    def token_fields(self, token: Column) -> list[Column]:
        """The forms and tags of a token of :meth:`found_tokens`."""
        tags = [tags for *_, tags in self._kinds()] + [Tags("名詞")]
        named = (F.get(F.array(*(F.lit(getattr(t, n)) for t in tags)), token["kind"]).alias(n) for n in Tags._fields)
        return [token["surface"].alias("surface"), token["normalized"].alias("normalized"), *named]

    def annotate(self, texts: DataFrame, text_col: str) -> DataFrame:
        """Add ``surfaces`` and ``flags``, two arrays of equal length in mode C, found in Arrow batches."""

        def found(batch: pa.Array) -> pa.Array:
            surfaces, flags, sizes = [pa.array([], pa.string())], [np.zeros(0, np.int32)], []
            for part in runs.steps(batch):
                tokens, own, firsts = runs.flagged_tokens(part, _tables(type(self)))
                surfaces.append(tokens)
                flags.append(own)
                sizes.append(np.diff(firsts))
            values = pa.concat_arrays(surfaces), pa.array(np.concatenate(flags), pa.int32())
            return pa.StructArray.from_arrays([_lists_of_known(v, sizes, batch) for v in values], ["surfaces", "flags"])

        return _annotated(texts, runs.by_batch(found, ANNOTATION)(F.col(text_col)))

    def sentences(self, text: Column) -> Column:
        """Array of the sentences of ``text``, by the rules of ``operators.segment`` on its tokens."""
        return F.transform(self.segments(text), lambda s: s["sentence"])

    def segments(self, text: Column) -> Column:
        """Array of (sentence, fault, japanese): the first structural rule it breaks, and the Japanese characters of ``text``
        on its first sentence, 0 on the others.

        They are found in Arrow batches (``operators.runs``), without an array of tokens.
        """

        def found(texts: pa.Array) -> pa.Array:
            parts, sizes = [], []
            for part in runs.steps(texts):
                strings, fault, counted, firsts = runs.find_sentences(part, _tables(type(self)), Flag)
                columns = [strings, runs.FAULTS.take(pa.array(fault)), pa.array(counted)]
                parts.append(pa.StructArray.from_arrays(columns, SEGMENT.elementType.names))
                sizes.append(np.diff(firsts))
            values = pa.concat_arrays(parts) if parts else pa.array([], pa.struct([(n, t) for n, t in _SEGMENT_FIELDS]))
            return _lists_of_known(values, sizes, texts)

        return runs.by_batch(found, SEGMENT)(text)

    def structure_fault(self, sentence: Column) -> Column:
        """The first structural rule a sentence of :meth:`sentences` breaks, or null: ``segment.structure_fault``."""

        def found(texts: pa.Array) -> pa.Array:
            parts = []
            for part in runs.steps(texts):
                _, fault, _, firsts = runs.find_sentences(part, _tables(type(self)), Flag, cut=False)
                broken = np.zeros(len(part), np.int64)  # a text without tokens has no predicate
                broken[np.diff(firsts) > 0] = fault
                parts.append(runs.FAULTS.take(pa.array(broken)))
            faults = pa.concat_arrays(parts) if parts else pa.array([], pa.string())
            return pc.if_else(texts.is_valid(), faults, None)

        return runs.by_batch(found, T.StringType())(sentence)

    def _kinds(self) -> list[tuple[str, Iterable[str], str, Tags]]:
        """(what is looked at, what it may be, an example, its tags) of each kind of token, the first that fits counts."""
        final, continuative = "終止形-一般", "連用形-一般"
        return [
            ("surface", WHITESPACE_CHARS, " ", Tags(BLANK)),
            ("surface", self.STOPS, "。", Tags(SYMBOL, FULL_STOP)),
            ("surface", self.COMMAS, "、", Tags(SYMBOL, COMMA)),
            ("surface", QUOTE_OPEN, "「", Tags(SYMBOL)),
            ("surface", QUOTE_CLOSE, "」", Tags(SYMBOL)),
            ("surface", CUT_OFF_MARKS, "・", Tags(SYMBOL)),
            ("surface", self.SYMBOLS, "（", Tags(SYMBOL)),
            ("surface", self.PARTICLES, "が", Tags(PARTICLE)),
            ("surface", self.OTHER_PARTICLES, "の", Tags(PARTICLE)),
            ("surface", self.AUXILIARIES, "です", Tags(AUXILIARY, conjugation=final)),
            ("ending", self.CONCLUSIVE_ENDINGS, "行く", Tags(VERB, conjugation=final)),
            ("ending", self.CONTINUATIVE_ENDINGS, "行き", Tags(VERB, conjugation=continuative)),
            ("ending", self.ADJECTIVE_ENDINGS, "赤い", Tags(ADJECTIVE, conjugation=final)),
            ("emoji", (), "🧡", Tags(SYMBOL)),
        ]

    def _classify(self, s: Column, result: Callable[[str, Tags], Column]) -> Column:
        """Choose by surface or ending. ``result`` gets one surface of each kind, which stands for the others."""
        ending = F.substring(s, -1, 1)
        chosen = F
        for part, values, example, tags in self._kinds():
            holds = starts_with_emoji(s) if part == "emoji" else (s if part == "surface" else ending).isin(*values)
            chosen = chosen.when(holds, result(example, tags))
        return chosen.otherwise(result("犬", Tags("名詞")))


@lru_cache(4)
def _tables(analyser: type[ScriptRunAnalyser]) -> runs.Tables:
    """What ``operators.runs`` looks up by code point. Flags of words of several characters must follow from their endings."""
    tables = runs.Tables(*(np.zeros(0x110000, t) for t in (np.int8, np.int16, np.int16, np.int8)))
    katakana = analyser.KATAKANA_RUN[1:-2]
    for number, char_class in enumerate((KANJI, HIRAGANA, katakana, HALF_WIDTH_KATAKANA, LATIN, DIGIT), runs.KANJI_RUN):
        tables.kind[runs.members(char_class)] = number
    tables.counted[runs.members(JAPANESE)] = 1
    for part, values, example, tags in reversed(analyser()._kinds()):
        flags = rule_flags(example, tags)
        codes = runs.members(EMOJI) if part == "emoji" else [ord(v) for v in values if len(v) == 1]
        tables.alone[codes] = flags
        if part == "ending":
            tables.ending[codes] = flags
        for word in (v for v in values if len(v) > 1):
            if tables.ending[ord(word[-1])] != flags:
                raise ValueError(f"the flags of {word} do not follow from its ending")
    return tables


@lru_cache(8)
def _kinds_of_mode(analyser: type[ScriptRunAnalyser], mode: str) -> np.ndarray:
    """Kinds of run by code point. In mode A kanji and digits stand alone."""
    kinds = _tables(analyser).kind
    if mode != "A":
        return kinds
    kinds = kinds.copy()
    for char_class in (KANJI, DIGIT):
        kinds[runs.members(char_class)] = runs.NONE
    return kinds


HELD_BYTES = 1 << 24  # so much of counted units is held by a worker before they are added up


def _numbers_of(batch: pa.RecordBatch, by: list[str]) -> np.ndarray:
    """A number for each row, the same for rows that are equal in ``by``."""
    number = np.zeros(batch.num_rows, np.int64)
    for name in by:
        encoded = batch.column(name).dictionary_encode(null_encoding="encode")
        number = number * max(1, len(encoded.dictionary)) + encoded.indices.to_numpy(zero_copy_only=False)
    return number


def _counts_of(texts: pa.Array, analyser: type[ScriptRunAnalyser], modes, counts: list[str]) -> list[pa.Table]:
    """The distinct units of ``texts`` in each mode, with their counts in its column and 0 in the others."""
    tables = []
    for mode, name in zip(modes, counts):
        units, _ = runs.find_tokens(texts, _kinds_of_mode(analyser, mode), mode == "C")
        found = units.value_counts()
        zeros = pa.array(np.zeros(len(found), np.int64))
        columns = {c: found.field("counts") if c == name else zeros for c in counts}
        tables.append(pa.table({"unit": found.field("values"), **columns}))
    return tables


def _added(tables: list[pa.Table], counts: list[str]) -> pa.Table:
    whole = pa.concat_tables(tables)
    added = whole.group_by("unit", use_threads=False).aggregate([(name, "sum") for name in counts])
    return added.rename_columns([c.removesuffix("_sum") for c in added.column_names])


def _counted_batches(key: tuple[pa.Scalar, ...], counted: pa.Table, schema: T.StructType) -> Iterator[pa.RecordBatch]:
    for batch in counted.to_batches(max_chunksize=10_000):
        fixed = [pa.repeat(value, batch.num_rows) for value in key]
        yield pa.RecordBatch.from_arrays([*fixed, *(batch.column(n) for n in schema.names[len(key) :])], names=schema.names)


_FOUND_FIELDS = [("surface", pa.string()), ("normalized", pa.string()), ("kind", pa.int32())]
FOUND = T.ArrayType(
    T.StructType(
        [
            T.StructField("surface", T.StringType()),
            T.StructField("normalized", T.StringType()),
            T.StructField("kind", T.IntegerType()),
        ]
    )
)


@lru_cache(4)
def _kind_tables(analyser: type[ScriptRunAnalyser]) -> tuple[np.ndarray, np.ndarray, dict[str, int], np.ndarray]:
    """Places in ``_kinds`` of a token of one character and of a longer one that ends in it, by code point, of whole words,
    and the folded code points.
    """
    kinds = analyser()._kinds()
    alone, ending = np.full(0x110000, len(kinds), np.int32), np.full(0x110000, len(kinds), np.int32)
    words: dict[str, int] = {}
    for place, (part, values, _, _) in reversed([*enumerate(kinds)]):
        codes = runs.members(EMOJI) if part == "emoji" else [ord(v) for v in values if len(v) == 1]
        alone[codes] = place
        if part == "ending":
            ending[codes] = place
        words |= {v: place for v in values if len(v) > 1}
    folded = np.arange(0x110000, dtype=np.uint32)
    folded[[ord(c) for c in analyser.FOLD_FROM]] = [ord(c) for c in analyser.FOLD_TO]
    return alone, ending, words, folded


def _tagged_tokens(analyser: type[ScriptRunAnalyser], texts: pa.Array, mode: str) -> tuple[pa.StructArray, np.ndarray]:
    """(surface, normalized, kind) of the tokens of all ``texts``, and the number of the first of each text."""
    alone, ending, words, folded = _kind_tables(analyser)
    data, codes, byte_at, begins = runs.characters(texts)
    first = runs.first_characters(_kinds_of_mode(analyser, mode)[codes], begins, mode == "C")
    bounds = np.append(first, len(codes))
    last = bounds[1:] - 1
    surfaces = pa.StringArray.from_buffers(len(first), pa.py_buffer(byte_at[bounds].tobytes()), data)
    kind = np.where(first == last, alone[codes[last]], ending[codes[last]])
    listed = pc.index_in(surfaces, value_set=pa.array([*words], pa.string())).fill_null(-1).to_numpy()
    known = np.flatnonzero(listed >= 0)
    kind[known] = np.minimum(kind[known], np.array([*words.values(), 0], np.int32)[listed[known]])
    return pa.StructArray.from_arrays([surfaces, runs.slices(folded[codes], bounds), pa.array(kind, pa.int32())], [n for n, _ in _FOUND_FIELDS]), np.searchsorted(first, begins)


FLAT = str.maketrans(LINE_BREAKS, " " * len(LINE_BREAKS))
TOKEN_NAMES = ("surface", "normalized", *Tags._fields)
TOKEN = T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in TOKEN_NAMES]))
FORM = T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in TOKEN_NAMES[:2]]))
ANNOTATION = T.StructType(
    [
        T.StructField("surfaces", T.ArrayType(T.StringType())),
        T.StructField("flags", T.ArrayType(T.IntegerType())),
    ]
)

_SEGMENT_FIELDS = [("sentence", pa.string()), ("fault", pa.string()), ("japanese", pa.int64())]
SEGMENT = T.ArrayType(
    T.StructType(
        [
            T.StructField("sentence", T.StringType()),
            T.StructField("fault", T.StringType()),
            T.StructField("japanese", T.LongType()),
        ]
    )
)

_KNOWN = 1 << 16  # most tokens of a text are frequent ones; so many answers are kept per worker


@lru_cache(_KNOWN)
def _flags_of(surface: str, *tags: str) -> int:
    return rule_flags(surface, Tags(*tags))


class _FlagsOfTokens(dict):
    """Flags by whole token, of the frequent ones that :func:`_flags_of` would be asked for again and again."""

    def __missing__(self, token: tuple) -> int:
        flags = _flags_of(token[0], *token[2:5])
        if len(self) < _KNOWN:
            self[token] = flags
        return flags


@lru_cache(_KNOWN)
def _flattened(form: str | None) -> str | None:
    return None if form is None else form.translate(FLAT)


def _lists(values: pa.Array, sizes: list[int | None]) -> pa.ListArray:
    """``values`` cut into lists of these sizes; None is a null list."""
    ends, known = [0], []
    for size in sizes:
        ends.append(ends[-1] + (size or 0))
        known.append(size is None)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values, mask=pa.array(known, pa.bool_()))


def _lists_of_known(values: pa.Array, sizes: list[np.ndarray], texts: pa.Array) -> pa.ListArray:
    """``values`` cut into lists of these sizes, null where the text is."""
    ends = np.zeros(len(texts) + 1, np.int32)
    np.cumsum(np.concatenate([*sizes, np.zeros(0, np.int64)]), out=ends[1:])
    return pa.ListArray.from_arrays(pa.array(ends), values, mask=texts.is_null())


def _columns(tokens: list[tuple], names: tuple[str, ...], change: Callable = lambda value: value) -> pa.StructArray:
    fields = [pa.array([change(t[i]) for t in tokens], pa.string()) for i in range(len(names))]
    return pa.StructArray.from_arrays(fields, list(names))


def _annotated(texts: DataFrame, found: Column) -> DataFrame:
    return (
        texts.withColumn("_found", found)
        .withColumn("surfaces", F.col("_found.surfaces"))
        .withColumn("flags", F.col("_found.flags"))
        .drop("_found")
    )


_IN_WORKER: dict[tuple[str, str], Callable] = {}


def worker_analyser(factory: Callable[[], Callable]) -> Callable:
    """The factory's analyser, made once per worker process if the factory is a function of a module.

    A function made at run time may hold different values under one name, so it is called for each task.
    """
    name = (getattr(factory, "__module__", ""), getattr(factory, "__qualname__", "<"))
    if "<" in name[1] or name[0] == "__main__" or getattr(factory, "__closure__", None):
        return factory()
    if name not in _IN_WORKER:
        _IN_WORKER[name] = factory()
    return _IN_WORKER[name]


def _analyse_to(tokens: list[tuple], analyse: Callable, text: str, mode: str, fails: bool) -> int | None:
    """Add the tokens of ``text`` and tell their number; unless it ``fails``, None for a text the analyser raised on."""
    before = len(tokens)
    try:
        tokens.extend(analyse(text, mode))
    except Exception:
        if fails:
            raise
        del tokens[before:]
        logging.getLogger(__name__).exception("analyser failed on a text")
        return None
    return len(tokens) - before


def _segments_of(texts: pa.Array, known: np.ndarray, analyse: Callable, counted: np.ndarray) -> tuple[pa.StructArray, np.ndarray]:
    """(sentence, fault, japanese) of the ``known`` ones of ``texts``, and the number of sentences of each text."""
    tokens: list[tuple] = []
    pairs = zip(texts.to_pylist(), known)
    sizes = [_analyse_to(tokens, analyse, text, "C", fails=False) if here else 0 for text, here in pairs]
    failed = np.array([size is None for size in sizes], np.bool_)
    first_token = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum([size or 0 for size in sizes], out=first_token[1:])

    surfaces = pa.array([t[0] for t in tokens], pa.string())
    flags_of = _FlagsOfTokens()
    flags = np.fromiter((flags_of[tuple(t)] for t in tokens), np.int32, len(tokens))
    first, last = runs.sentence_bounds(flags, first_token, Flag)
    strings = runs.joined(surfaces, first)
    marked = [pc.match_substring(strings, mark).to_numpy(zero_copy_only=False) for mark in MARKUP]
    fault = runs.broken_rules(flags, first, last, np.logical_or(*marked), Flag)

    found = np.diff(np.searchsorted(first, first_token))
    alone = known & (found == 0)  # texts without tokens, and those the analyser failed on
    sizes = np.where(alone, 1, found)
    begins = np.cumsum(sizes) - sizes
    order = np.zeros(int(sizes.sum()), np.int64)
    own = np.zeros(len(order), np.bool_)
    own[begins[alone]] = True
    order[own], order[~own] = len(strings) + np.arange(alone.sum()), np.arange(len(strings))
    whole = texts.filter(pa.array(alone))
    whole = pc.if_else(pa.array(failed[alone]), whole, "")
    faults = np.concatenate([fault, np.where(failed[alone], runs.ANALYSER_ERROR, runs.NO_CONTENT)])
    japanese = np.zeros(len(order), np.int64)
    _, codes, _, bounds = runs.characters(texts)
    japanese[begins[sizes > 0]] = runs.sums(counted[codes], bounds)[sizes > 0]
    columns = [pa.concat_arrays([strings, whole]).take(pa.array(order)), runs.FAULTS.take(pa.array(faults[order])), pa.array(japanese)]
    return pa.StructArray.from_arrays(columns, SEGMENT.elementType.names), sizes


class PythonAnalyser:
    """A user's analyser, applied to Arrow batches inside the tasks.

    ``factory`` runs once per worker process (:func:`worker_analyser`) and returns ``analyse(text, mode)``, which yields (surface, normalized, word class,
    sub-class, conjugation form) per token. :meth:`annotate` gives null arrays for a text on which it raises, and the
    extraction rejects that text; elsewhere the error fails the job. ``max_line_bytes`` is the longest text the analyser
    takes, in UTF-8 bytes; longer lines reach it in pieces.
    """

    def __init__(
        self, factory: Callable[[], Callable[[str, str], Iterable[tuple]]], max_line_bytes: int | None = None
    ):
        self.factory = factory
        self.max_line_bytes = max_line_bytes

    def units(self, text: Column, mode: str = "C", flat: bool = False) -> Column:
        """Array of (surface, normalized); with ``flat``, line breaks inside them are spaces."""
        change = (_flattened,) if flat else ()
        return self._per_batch(FORM, (mode,), lambda t, sizes: _lists(_columns(t, TOKEN_NAMES[:2], *change), sizes))(text)

    def pieces(self, line: Column, chars: int) -> Column:
        """The whole line: an analyser without ``max_line_bytes`` takes lines of any length."""
        return F.array(line)

    def units_by_mode(self, text: Column, modes=MODES) -> Column:
        """Array of (mode, units) with line breaks flattened, from one call per text and mode in one pass."""
        returns = T.ArrayType(T.StructType([T.StructField("mode", T.StringType()), T.StructField("units", FORM)]))

        def build(tokens, sizes):
            units = _lists(_columns(tokens, TOKEN_NAMES[:2], _flattened), sizes)
            names = pa.array([*modes] * (len(sizes) // len(modes)), pa.string())
            known = [None if size is None else len(modes) for size in sizes[:: len(modes)]]
            per_mode = pa.StructArray.from_arrays([names, units], ["mode", "units"])
            if None in known:  # a null list holds nothing
                per_mode = per_mode.filter(pa.array([size is not None for size in sizes], pa.bool_()))
            return _lists(per_mode, known)

        return self._per_batch(returns, tuple(modes), build)(text)

    def surface(self, unit: Column) -> Column:
        return unit["surface"]

    def normalized(self, unit: Column) -> Column:
        return unit["normalized"]

    def tokens(self, text: Column, mode: str = "C") -> Column:
        return self._per_batch(TOKEN, (mode,), lambda t, sizes: _lists(_columns(t, TOKEN_NAMES), sizes))(text)

    def annotate(self, texts: DataFrame, text_col: str) -> DataFrame:
        """Add ``surfaces`` and ``flags``, two arrays of equal length in mode C; null where the analyser failed."""

        def build(tokens, sizes):
            surfaces = pa.array([t[0] for t in tokens], pa.string())
            flags = pa.array([_flags_of(t[0], *t[2:5]) for t in tokens], pa.int32())
            return pa.StructArray.from_arrays([_lists(surfaces, sizes), _lists(flags, sizes)], ["surfaces", "flags"])

        found = self._per_batch(ANNOTATION, ("C",), build, fails=False)(F.col(text_col))
        return _annotated(texts, found)

    def segments(self, text: Column) -> Column:
        """As :meth:`ScriptRunAnalyser.segments`, from the tokens of some texts at a time. A text without tokens is one empty
        sentence; one the analyser failed on is a sentence with the fault ``analyser_error``.
        """
        factory = self.factory

        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            analyse, counted = worker_analyser(factory), _tables(ScriptRunAnalyser).counted
            for batch in batches:
                parts, sizes = [], []
                for part in runs.steps(batch):
                    known = batch.slice(sum(map(len, sizes)), len(part)).is_valid().to_numpy(zero_copy_only=False)
                    sentences, size = _segments_of(part, known, analyse, counted)
                    parts.append(sentences)
                    sizes.append(size)
                values = pa.concat_arrays(parts) if parts else pa.array([], pa.struct(_SEGMENT_FIELDS))
                yield _lists_of_known(values, sizes, batch)

        run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
        return F.arrow_udf(run, SEGMENT)(text)

    def _per_batch(self, returns: T.DataType, modes: tuple[str, ...], build: Callable, fails: bool = True):
        """A function of a text column. ``build`` gets the tokens of a batch of texts, text by text and mode by mode, and
        their numbers, None for a null text and, unless it ``fails``, for one the analyser raised on.
        """
        factory = self.factory

        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            analyse = worker_analyser(factory)
            for batch in batches:
                tokens, sizes = [], []
                for text in batch.to_pylist():
                    for mode in modes:
                        sizes.append(None if text is None else _analyse_to(tokens, analyse, text, mode, fails))
                yield build(tokens, sizes)

        run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
        return F.arrow_udf(run, returns)


def explode_tokens(texts: DataFrame, analyser, mode: str = "C", text_col: str = "chunk") -> DataFrame:
    """Token table: the other columns of ``texts`` plus pos, forms and tags."""
    keep = [c for c in texts.columns if c != text_col]
    if hasattr(analyser, "found_tokens"):  # tags are told behind the explosion, not carried through it
        found = texts.select(*keep, F.posexplode(analyser.found_tokens(F.col(text_col), mode)).alias("pos", "token"))
        return found.select(*keep, "pos", *analyser.token_fields(F.col("token")))
    tokens = analyser.tokens(F.col(text_col), mode)
    return texts.select(*keep, F.posexplode(tokens).alias("pos", "token")).select(*keep, "pos", "token.*")


def units_of_modes(text: Column, analyser, modes=MODES) -> Column:
    """Array of (mode, units), line breaks flattened; a Python analyser gets each text once per mode, in one pass."""
    if isinstance(analyser, PythonAnalyser):
        return analyser.units_by_mode(text, modes)
    units = [analyser.units(text, mode, flat=True).alias("units") for mode in modes]
    return F.array(*(F.struct(F.lit(mode).alias("mode"), u) for mode, u in zip(modes, units)))


def token_table(sentences: DataFrame, analyser, text_col: str = "clean") -> DataFrame:
    """``sentences`` with their ``digest`` and ``tokens``, what :func:`units_of_modes` gives.

    To be staged once and read by all that look tokens up or count them.
    """
    text = F.col(text_col)
    return sentences.select("*", F.unhex(F.md5(text)).alias("digest"), units_of_modes(text, analyser).alias("tokens"))


def units_of(tokens: Column, mode: str = "C") -> Column:
    """The units of one mode of a token table."""
    return F.get(F.filter(tokens, lambda t: t["mode"] == mode), F.lit(0))["units"]


def explode_units(texts: DataFrame, analyser, modes=MODES, text_col: str = "clean") -> DataFrame:
    """(mode, unit) of every token in every mode, line breaks flattened; one pass over the texts.

    Texts that come with their ``tokens`` (:func:`token_table`) are not analysed again.
    """
    known = "tokens" in texts.columns
    keep = [c for c in texts.columns if c not in (text_col, "tokens")]
    per_mode = F.col("tokens") if known else units_of_modes(F.col(text_col), analyser, modes)
    return texts.select(*keep, F.inline(per_mode)).select(*keep, "mode", F.explode("units").alias("unit"))


def with_forms(units: DataFrame, analyser) -> DataFrame:
    """Replace ``unit`` by surface and normalized.

    They leave through a one-element array: a later filter on them would otherwise move below the counts of ``units`` and
    normalize every token instead of every type.
    """
    unit, keep = F.col("unit"), [c for c in units.columns if c != "unit"]
    forms = F.struct(analyser.surface(unit).alias("surface"), analyser.normalized(unit).alias("normalized"))
    return units.select(F.inline(F.array(forms)), *keep)
