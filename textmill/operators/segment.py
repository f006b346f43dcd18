"""Sentence segmentation over token arrays.

The state machine (inside a quote? what was the previous token?) runs inside each chunk's arrays. Nothing is
shuffled: a window over exploded tokens would send every token of the corpus across the network to learn what its
neighbour, already in the same row, has to say.

A line too long for one array comes in pieces (:func:`join_pieces`). What a piece does to the state is small: its last
token, and whether its last quote mark opens or closes. These are combined over the pieces in a tree, so that each piece
knows the state it begins in, and the parts of a sentence in several pieces meet at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.functions.chars import contains_any, strip
from textmill.operators.runs import ends_in_pieces
from textmill.operators.scan import BLOCK, running_before
from textmill.operators.tokens import MARKUP, Flag
from textmill.storage import stage_table


def has(flags: Column, bits: int) -> Column:
    return flags.bitwiseAND(F.lit(bits)) != 0


def _marks(flags: Column, first_before: Column) -> Column:
    """One letter per token: ``(`` opens a quote, ``)`` closes one, ``|`` ends a sentence, ``]`` closes and ends.

    ``first_before`` holds the flags of the token before the first, if there is one.
    """

    def mark(flag, i):
        before = F.coalesce(F.get(flags, i - 1), first_before, F.lit(0))
        ends = (
            has(flag, Flag.STOP)
            | (has(flag, Flag.PAUSE) & has(before, Flag.CONCLUSIVE))
            | (has(flag, Flag.EMOJI) & has(before, Flag.PREDICATE))
        )
        return (
            F.when(flag == 0, "-")
            .when(has(flag, Flag.QUOTE_OPEN), "(")
            .when(has(flag, Flag.QUOTE_CLOSE), F.when(ends, "]").otherwise(")"))
            .when(ends, "|")
            .otherwise("-")
        )

    return F.array_join(F.transform(flags, mark), "")


def _outside_quotes(marks: Column) -> Column:
    """Blank out marks from an opening quote up to its closing one. Quotes do not nest: any closing mark ends them.

    ``\\G`` continues where the last match ended, so each masked mark is replaced by one character.
    """
    return F.regexp_replace(marks, r"\(|(?!\A)\G[^)\]]", "-")


def sentence_ends(flags: Column) -> Column:
    """1-based positions of the last token of each sentence; leftover tokens form the last one."""
    marks = F.split(_outside_quotes(_marks(flags, F.lit(None).cast("int"))), "")
    last = F.size(flags)
    positions = F.transform(marks, lambda m, i: F.when(m.isin("|", "]") | (i + 1 == last), i + 1))
    return F.filter(positions, lambda p: p.isNotNull() & (p <= last))


def split_sentences(chunks: DataFrame) -> DataFrame:
    """``surfaces`` and ``flags`` of a chunk to one row per sentence: sent_no, text (joined) and its flags.

    A chunk without tokens keeps one row with nulls.
    """
    ends, surfaces, flags = F.col("_ends"), F.col("surfaces"), F.col("flags")

    def sentence(end, i):
        begin = F.coalesce(F.get(ends, i - 1), F.lit(0))
        part = [begin + 1, end - begin]
        return F.struct(
            F.array_join(F.slice(surfaces, *part), "").alias("text"), F.slice(flags, *part).alias("flags")
        )

    keep = [c for c in chunks.columns if c not in ("surfaces", "flags")]
    return (
        chunks.withColumn("_ends", sentence_ends(flags))
        .select(*keep, F.posexplode_outer(F.transform(ends, sentence)).alias("sent_no", "_sentence"))
        .select(*keep, "sent_no", strip(F.col("_sentence.text")).alias("text"), "_sentence.flags")
    )


def join_pieces(pieces: DataFrame, keys: list[str], block: int = BLOCK) -> DataFrame:
    """Sentences of lines that come in pieces, cut between any two tokens: keys, sent_no, text, flags and ``extra``.

    ``pieces`` has the keys of the line, piece_no (from 0), surfaces, flags and a number ``extra``, of which a sentence gets
    the sum over the pieces that begin in it. They are read three times, so they should be a written table. The result is that of :func:`split_sentences` over whole lines.
    """
    place, flags = [*keys, "piece_no"], F.col("flags")
    quotes = F.filter(flags, lambda f: has(f, Flag.QUOTE_OPEN | Flag.QUOTE_CLOSE))
    last = lambda array: F.get(array, F.size(array) - 1)
    told = pieces.select(*place, last(flags).alias("token"), has(last(quotes), Flag.QUOTE_OPEN).alias("quoted"))
    state = running_before(told, keys, "piece_no", latest=["token", "quoted"], block=block)
    ends = ends_in_pieces(flags, F.col("token_before"), F.col("quoted_before"), Flag)
    ended = stage_table(pieces.join(state, place).select(*place, ends.alias("ends")), "piece-ends")
    numbered = running_before(ended.withColumn("n", F.size("ends")), keys, "piece_no", sums=["n"], block=block)

    def part(k):
        begin = F.coalesce(F.get("ends", k - 1), F.lit(0))
        size = F.coalesce(F.get("ends", k), F.size(flags)) - begin
        cut = [begin + 1, size]
        return F.struct(
            (F.col("n_before") + k).cast("int").alias("sent_no"),
            F.array_join(F.slice("surfaces", *cut), "").alias("text"),
            F.slice(flags, *cut).alias("flags"),
            F.when(k == 0, F.col("extra")).otherwise(F.lit(0)).alias("extra"),
        )

    parts = F.transform(F.sequence(F.lit(0), F.col("n")), part)
    found = pieces.join(numbered, place).select(*place, F.inline(parts)).filter((F.size("flags") > 0) | (F.col("extra") > 0))
    whole = found.groupBy(*keys, "sent_no").agg(
        F.array_sort(F.collect_list(F.struct("piece_no", "text", "flags"))).alias("parts"), F.sum("extra").alias("extra")
    )
    return whole.select(
        *keys,
        "sent_no",
        strip(F.array_join(F.transform("parts", lambda p: p["text"]), "")).alias("text"),
        F.flatten(F.transform("parts", lambda p: p["flags"])).alias("flags"),
        "extra",
    )


def structure_fault(text: Column, flags: Column) -> Column:
    """The first structural rule a sentence breaks, or null."""
    last = F.get(flags, F.size(flags) - 1)
    words = F.filter(flags, lambda f: ~has(f, Flag.FILLER))
    last_word = F.get(words, F.size(words) - 1)
    return (
        F.when(~F.exists(flags, lambda f: has(f, Flag.PREDICATE)), "no_predicate")
        .when(has(last, Flag.COMMA), "ends_comma")
        .when(last_word.isNull(), "no_content")
        .when(has(last_word, Flag.CUT_OFF_PARTICLE), "ends_particle")
        .when(~has(last, Flag.STOP) & has(last_word, Flag.CONTINUATIVE), "ends_continuative")
        .when(contains_any(text, MARKUP), "markup")
        .when(has(last, Flag.CUT_OFF_MARK), "ends_mark")
    )
