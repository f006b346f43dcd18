"""Tokens and sentences of script runs, batch by batch: the rules of ``operators.segment`` over arrays of characters.

What a token is, and all its flags, follow from a character and its neighbours, so lookups by code point and running maxima
over all texts of a batch replace arrays of tokens. Sentences are slices of the batch's own bytes.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.functions import chars

STEP_BYTES = 1 << 20  # so much text, or one longer text, is looked at at once
NONE, KANJI_RUN, HIRAGANA_RUN = 0, 1, 2  # kinds of character; other runs follow
_CODES = 0x110000


class Tables(NamedTuple):
    """By code point: the kind of run, flags of the token it makes up alone and of a longer one that ends in it, counts."""

    kind: np.ndarray
    alone: np.ndarray
    ending: np.ndarray
    counted: np.ndarray


@lru_cache(1)
def _every_character() -> str:
    return "".join(map(chr, range(_CODES)))


@lru_cache(64)
def members(char_class: str) -> np.ndarray:
    """Code points of a class written as for Spark."""
    pattern = "[" + re.sub(r"\\x\{(\w+)\}", lambda m: re.escape(chr(int(m[1], 16))), char_class) + "]"
    return np.array([ord(c) for c in re.findall(pattern, _every_character())], np.int64)


def steps(texts: pa.Array) -> Iterator[pa.Array]:
    """Parts of ``texts`` of bounded bytes, without nulls and with valid UTF-8 only."""
    if not len(texts):
        return
    texts = texts.fill_null("")
    try:
        texts.validate(full=True)
    except pa.ArrowInvalid:
        whole = texts.cast(pa.binary()).to_pylist()
        texts = pa.array([t.decode("utf-8", "replace") for t in whole], pa.string())
    offsets = _offsets(texts)
    begin = 0
    while begin < len(texts):
        end = max(begin + 1, int(np.searchsorted(offsets, offsets[begin] + STEP_BYTES, "right")) - 1)
        yield texts.slice(begin, end - begin)
        begin = end


def _offsets(texts: pa.Array) -> np.ndarray:
    return np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]


def characters(texts: pa.Array) -> tuple[pa.Buffer, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of ``texts``, their code points, the byte each begins at, and the first of each text (all with the end)."""
    offsets = _offsets(texts)
    data = texts.buffers()[2]
    data = data.slice(int(offsets[0]), int(offsets[-1] - offsets[0])) if data is not None else pa.py_buffer(b"")
    codes = np.frombuffer(data.to_pybytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    byte_at = np.zeros(len(codes) + 1, np.int32)
    np.cumsum(_sizes(codes), out=byte_at[1:])
    return data, codes, byte_at, np.searchsorted(byte_at, offsets - offsets[0])


def _sizes(codes: np.ndarray) -> np.ndarray:
    """Bytes of each character."""
    return 1 + (codes > 0x7F).astype(np.int8) + (codes > 0x7FF) + (codes > 0xFFFF)


def slices(codes: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Strings of the characters ``codes`` from each of ``bounds`` up to the next."""
    byte_at = np.zeros(len(codes) + 1, np.int32)
    np.cumsum(_sizes(codes), out=byte_at[1:])
    data = codes.astype("<u4").tobytes().decode("utf-32-le").encode()
    return pa.StringArray.from_buffers(len(bounds) - 1, pa.py_buffer(byte_at[bounds].tobytes()), pa.py_buffer(data))


def joined(strings: pa.Array, begins: np.ndarray) -> pa.Array:
    """Runs of ``strings`` from each of ``begins`` up to the next, put together; nulls add nothing."""
    bounds = _offsets(strings)[np.append(begins, len(strings))]
    return pa.StringArray.from_buffers(len(begins), pa.py_buffer(bounds.tobytes()), strings.buffers()[2] or pa.py_buffer(b""))


def sums(values: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Sums of ``values`` from each of ``begins`` up to the next."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return np.diff(total[begins])


def _before(values: np.ndarray, first) -> np.ndarray:
    """Each element's predecessor, ``first`` for the first."""
    shifted = np.empty_like(values)
    shifted[:1], shifted[1:] = first, values[:-1]
    return shifted


def first_characters(kind: np.ndarray, begins: np.ndarray, joined: bool = True) -> np.ndarray:
    """First characters of the tokens: runs of one kind, each ``NONE`` by itself, ``joined`` hiragana behind kanji."""
    before = _before(kind, NONE)
    new = (kind == NONE) | (kind != before)
    if joined:
        new &= ~((kind == HIRAGANA_RUN) & (before == KANJI_RUN))
    new[begins[begins < len(kind)]] = True
    return np.flatnonzero(new)


def find_tokens(texts: pa.Array, kinds: np.ndarray, joined: bool) -> tuple[pa.Array, np.ndarray]:
    """Surfaces of the tokens of all ``texts``, and the number of the first of each text."""
    data, codes, byte_at, begins = characters(texts)
    token = first_characters(kinds[codes], begins, joined)
    offsets = byte_at[np.append(token, len(codes))]
    return pa.StringArray.from_buffers(len(token), pa.py_buffer(offsets.tobytes()), data), np.searchsorted(token, begins)


def _flags(codes: np.ndarray, token: np.ndarray, tables: Tables) -> np.ndarray:
    """Flags of the tokens that begin at the characters ``token``."""
    last_char = np.append(token[1:], len(codes))[: len(token)] - 1
    return np.where(token == last_char, tables.alone[codes[last_char]], tables.ending[codes[last_char]])


def flagged_tokens(texts: pa.Array, tables: Tables) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Surfaces and flags of the tokens of all ``texts``, and the number of the first of each text."""
    data, codes, byte_at, begins = characters(texts)
    token = first_characters(tables.kind[codes], begins)
    offsets = byte_at[np.append(token, len(codes))]
    surfaces = pa.StringArray.from_buffers(len(token), pa.py_buffer(offsets.tobytes()), data)
    return surfaces, _flags(codes, token, tables), np.searchsorted(token, begins)


def by_batch(fn: Callable[[pa.Array], pa.Array], returns: T.DataType):
    """A function of a text column from one of an Arrow array."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from map(fn, batches)

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, returns)


@lru_cache(1)
def _useful() -> np.ndarray:
    """What each character adds to the useful ones: the middle dot is in two classes."""
    table = np.zeros(_CODES, np.int8)
    for char_class in (chars.JAPANESE, chars.PUNCTUATION, chars.DIGIT):
        table[members(char_class)] += 1
    return table


def density(text: Column) -> Column:
    """``chars.density``, in Arrow batches."""

    def useful(texts: pa.Array) -> pa.Array:
        found = [np.zeros(0, np.int64)]
        for part in steps(texts):
            _, codes, _, begins = characters(part)
            found.append(sums(_useful()[codes], begins))
        return pc.if_else(texts.is_valid(), pa.array(np.concatenate(found)), None)

    count = by_batch(useful, T.LongType())(text)
    return F.coalesce(F.try_divide(count.cast("double"), F.length(text).cast("double")), F.lit(0.0))


def _has(values: np.ndarray, bits: int) -> np.ndarray:
    return (values & bits) != 0


def ending_tokens(flags: np.ndarray, first_token: np.ndarray, flag, before=0, quoted=False) -> np.ndarray:
    """Does each token end a sentence? Texts, whose tokens begin at ``first_token`` (with the end), come behind a token with
    the flags ``before``, and in a quote or not: one value for all of them or one for each.
    """
    sizes = np.diff(first_token)
    filled = sizes > 0
    previous = _before(flags, 0)
    previous[first_token[:-1][filled]] = np.broadcast_to(before, len(sizes))[filled]
    ends = _has(flags, flag.STOP)
    ends |= _has(flags, flag.PAUSE) & _has(previous, flag.CONCLUSIVE)
    ends |= _has(flags, flag.EMOJI) & _has(previous, flag.PREDICATE)
    quotes = np.maximum.accumulate(np.where(_has(flags, flag.QUOTE_OPEN | flag.QUOTE_CLOSE), np.arange(len(flags)), -1))
    quote = _before(quotes, -1)
    own = quote >= np.repeat(first_token[:-1], sizes)
    inside = np.where(own, _has(flags[quote], flag.QUOTE_OPEN), np.repeat(np.broadcast_to(quoted, len(sizes)), sizes))
    return ends & ~_has(flags, flag.QUOTE_OPEN) & (_has(flags, flag.QUOTE_CLOSE) | ~inside)


def sentence_bounds(flags: np.ndarray, first_token: np.ndarray, flag, cut: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """First and last tokens of the sentences of texts whose tokens begin at ``first_token`` (with the end), or of whole texts."""
    filled = np.diff(first_token) > 0
    ends = ending_tokens(flags, first_token, flag) if cut else np.zeros(len(flags), np.bool_)
    ends[first_token[1:][filled] - 1] = True
    last = np.flatnonzero(ends)
    return _before(last + 1, 0), last


def broken_rules(flags: np.ndarray, first: np.ndarray, last: np.ndarray, markup: np.ndarray, flag) -> np.ndarray:
    """Place in ``FAULTS`` of the first structural rule that each sentence breaks."""
    words = np.maximum.accumulate(np.where(_has(flags, flag.FILLER), -1, np.arange(len(flags))))[last]
    last_flags, word_flags = flags[last], flags[words]
    any_flags = np.bitwise_or.reduceat(flags, first) if len(first) else flags
    broken = (
        ~_has(any_flags, flag.PREDICATE),
        _has(last_flags, flag.COMMA),
        words < first,
        _has(word_flags, flag.CUT_OFF_PARTICLE),
        ~_has(last_flags, flag.STOP) & _has(word_flags, flag.CONTINUATIVE),
        markup,
        _has(last_flags, flag.CUT_OFF_MARK),
    )
    return np.select(broken, range(len(broken)), len(broken))


def flags_of_lists(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The flags in ``lists``, one after the other, and the first of each list (with the end); a null list is empty."""
    bounds = np.zeros(len(lists) + 1, np.int64)
    np.cumsum(pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False), out=bounds[1:])
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int32), bounds


def ends_in_pieces(flags: Column, before: Column, quoted: Column, flag) -> Column:
    """1-based positions of tokens that end a sentence, in an array of flags behind a token and in a quote or not."""

    def found(pieces: pa.Array) -> pa.Array:
        lists, token, in_quote = pieces.flatten()
        values, bounds = flags_of_lists(lists)
        token = token.fill_null(0).to_numpy(zero_copy_only=False)
        in_quote = in_quote.fill_null(False).to_numpy(zero_copy_only=False)
        ends = np.flatnonzero(ending_tokens(values, bounds, flag, token, in_quote))
        firsts = np.searchsorted(ends, bounds)
        places = ends + 1 - np.repeat(bounds[:-1], np.diff(firsts))
        return pa.ListArray.from_arrays(pa.array(firsts, pa.int32()), pa.array(places, pa.int32()))

    state = F.struct(flags.alias("flags"), before.cast("int").alias("before"), quoted.alias("quoted"))
    return by_batch(found, T.ArrayType(T.IntegerType()))(state)


def find_sentences(texts: pa.Array, tables: Tables, flag, cut: bool = True):
    """Sentences of each of ``texts``, or the whole text as one: their strings, the rules broken (places in ``FAULTS``),
    counted characters of the text on its first, and the number of the first sentence of each text.
    """
    data, codes, byte_at, begins = characters(texts)
    token = first_characters(tables.kind[codes], begins)
    flags = _flags(codes, token, tables)
    first_token = np.searchsorted(token, begins)
    first, last = sentence_bounds(flags, first_token, flag, cut)
    begin_char = np.append(token[first], len(codes))
    doubled = np.flatnonzero((codes[1:] == codes[:-1]) & ((codes[1:] == ord("[")) | (codes[1:] == ord("]"))))
    sentence = np.searchsorted(begin_char, doubled, "right") - 1
    markup = np.zeros(len(last), np.bool_)
    markup[sentence[doubled + 1 < begin_char[sentence + 1]]] = True
    fault = broken_rules(flags, first, last, markup, flag)

    strings = pa.StringArray.from_buffers(len(last), pa.py_buffer(byte_at[begin_char].tobytes()), data)
    first_sentence = np.searchsorted(first, first_token)
    filled = np.diff(first_token) > 0
    counted = np.zeros(len(last), np.int64)
    counted[first_sentence[:-1][filled]] = sums(tables.counted[codes], begins)[filled]
    return strings, fault, counted, first_sentence


FAULTS = pa.array(
    ["no_predicate", "ends_comma", "no_content", "ends_particle", "ends_continuative", "markup", "ends_mark", None, "analyser_error"],
    pa.string(),
)
NO_CONTENT, ANALYSER_ERROR = 2, 8
