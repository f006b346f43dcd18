"""Sentence cleaning: leading marks, list numbers and brackets around the edges.

Both bracket rules repeat until nothing changes. A step removes a character from an edge, so the runs of brackets and
whitespace at the edges bound the number of steps, and a fold over an array of that size reaches the fixed point.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textmill.functions.chars import (
    DIGIT,
    WHITESPACE,
    WHITESPACE_CHARS,
    let,
    remove_whitespace,
    rstrip,
)

# Marks dropped from the start, and bracket pairs in order of precedence.
LEADING_MARKS = "＞>：:"
BRACKET_PAIRS = ("（）", "()", "［］", "[]", "【】", "「」", "｢｣", "＜＞", "<>")

_BRACKETS = "".join(BRACKET_PAIRS)
_EDGE = rf"（）()［］\[\]【】「」｢｣＜＞<>{WHITESPACE}"
_NO_PAIR = len(BRACKET_PAIRS)


def _peel(text: Column, step, **state: Column) -> Column:
    """Take characters off both ends of ``text``, one per ``step``, as long as brackets and whitespace reach.

    ``step`` maps the first and last character that are left, their number and the state (``head`` and ``tail``, the
    characters taken so far, and what else is given) to the next state. Characters come from arrays of the two runs, so a
    step takes the same time at any length and nothing is copied. Texts without edge brackets skip the fold.
    """

    def run(t):
        # The lookbehind keeps the search linear: a match can only begin where a run begins.
        leading = F.regexp_extract(t, rf"\A[{_EDGE}]++", 0)
        trailing = F.regexp_extract(t, rf"(?<![{_EDGE}])[{_EDGE}]++\z|\A[{_EDGE}]++\z", 0)
        first = {"head": F.lit(0), "tail": F.lit(0), "strip": F.lit(0), **{k: v(t) for k, v in state.items()}}
        given = F.struct(
            F.split(leading, "").alias("heads"),
            F.reverse(F.split(trailing, "")).alias("tails"),
            F.length(t).alias("length"),
            (F.length(leading) + F.length(trailing)).alias("most"),
            F.struct(*(v.alias(k) for k, v in first.items())).alias("start"),
        )

        def fold(e):
            def move(acc, _):
                left = e["length"] - acc["head"] - acc["tail"]
                return step(F.get(e["heads"], acc["head"]), F.get(e["tails"], acc["tail"]), left, acc)

            done = F.aggregate(F.array_repeat(F.lit(0), e["most"]), e["start"], move)
            return F.substring(t, done["head"] + 1, e["length"] - done["head"] - done["tail"])

        edges = F.concat(F.left(t, F.lit(1)), F.right(t, F.lit(1)))
        return F.when(edges.rlike(f"[{_EDGE}]"), let(given, fold)).otherwise(t)

    return let(text, run)


_LEFT, _RIGHT, _BOTH = 1, 2, 3  # sides that are being stripped


def _moved(acc: Column, strip, head=0, tail=0, **changed: Column) -> Column:
    names = {"head": acc["head"] + head, "tail": acc["tail"] + tail, "strip": F.lit(strip), **changed}
    return F.struct(*(v.alias(k) for k, v in names.items()))


def _blank(char: Column) -> Column:
    return char.isin(*WHITESPACE_CHARS)


def strip_matched_brackets(text: Column) -> Column:
    """Remove enclosing pairs. Only the first and last character are looked at: ``（a）b（c）`` loses both."""

    def step(head, tail, left, acc):
        return (
            F.when((left > 0) & (acc["strip"] == _BOTH) & _blank(head), _moved(acc, _BOTH, head=1))
            .when((left > 0) & (acc["strip"] == _BOTH) & _blank(tail), _moved(acc, _BOTH, tail=1))
            .when((left > 1) & F.concat(head, tail).isin(*BRACKET_PAIRS), _moved(acc, _BOTH, head=1, tail=1))
            .otherwise(acc)
        )

    return _peel(text, step)


def _bracket_counts(text: Column) -> Column:
    return F.array(*(F.length(text) - F.length(F.replace(text, F.lit(c), F.lit(""))) for c in _BRACKETS))


def strip_unbalanced_brackets(text: Column) -> Column:
    """Remove edge brackets that outnumber their mates: lowest pair first, head before tail, until none is left."""

    def place(char):
        return F.position(char, F.lit(_BRACKETS)) - 1

    def surplus(char, counts):
        """Precedence of the character's pair if it outnumbers its mate, else ``_NO_PAIR``."""
        outnumbers = F.get(counts, place(char)) > F.get(counts, place(char).bitwiseXOR(F.lit(1)))
        return F.when(char.isin(*_BRACKETS) & outnumbers, F.floor(place(char) / 2).cast("int")).otherwise(F.lit(_NO_PAIR))

    def step(head, tail, left, acc):
        counts = acc["counts"]
        fewer = lambda char: F.transform(counts, lambda n, i: F.when(i == place(char), n - 1).otherwise(n))
        h, t = surplus(head, counts), surplus(tail, counts)
        return (
            F.when(left <= 0, acc)
            .when((acc["strip"] == _LEFT) & _blank(head), _moved(acc, _LEFT, head=1, counts=counts))
            .when((acc["strip"] == _RIGHT) & _blank(tail), _moved(acc, _RIGHT, tail=1, counts=counts))
            .when((h == _NO_PAIR) & (t == _NO_PAIR), acc)
            .when(h <= t, _moved(acc, _LEFT, head=1, counts=fewer(head)))
            .otherwise(_moved(acc, _RIGHT, tail=1, counts=fewer(tail)))
        )

    return _peel(text, step, counts=_bracket_counts)


def strip_leading_marks(text: Column) -> Column:
    return rstrip(F.ltrim(text, F.lit(LEADING_MARKS + WHITESPACE_CHARS)))


def strip_list_number(text: Column) -> Column:
    """Remove ``12)`` or ``１．`` at the start; ``1.5倍`` becomes ``5倍``."""
    return F.regexp_replace(text, rf"\A[{DIGIT}]+[）)\.．][{WHITESPACE}]*", "")


def clean_sentence(text: Column) -> Column:
    """The whole chain. List numbers go twice, as removing brackets may uncover one.

    All but the last step look at the edges, so a text whose first and last character none of them takes skips them. It
    skips ``let`` as well, which Spark doesn't compile, so ``text`` should be a column, as it is read several times.
    """

    def chain(t):
        done = strip_list_number(strip_leading_marks(t))
        return strip_list_number(strip_unbalanced_brackets(strip_matched_brackets(done)))

    edges = F.concat(F.left(text, F.lit(1)), F.right(text, F.lit(1)))
    return remove_whitespace(F.when(edges.rlike(f"[{_EDGE}{LEADING_MARKS}{DIGIT}]"), let(text, chain)).otherwise(text))
