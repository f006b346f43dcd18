"""Joins against a ranked vocabulary ``(word, rank)``, rank 0 first. A word may be listed more than once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.operators.tokens import with_forms
from textmill.storage import BROADCAST_LIMIT_BYTES, fits_broadcast, stage_table

HEAD_WORDS = 100_000
FILTER_BYTES = 32 * 1024 * 1024
SALTS = 64
_ROW_WORDS = 512  # of 64 bits, in one row of a filter


def percentiles(vocab: DataFrame) -> DataFrame:
    """(word, percentile): ``100 * (1 - rank / lines)``; the last listing of a word counts."""
    lines = vocab.count()
    return (
        vocab.groupBy("word")
        .agg(F.max("rank").alias("rank"))
        .select("word", (100.0 * (1.0 - F.col("rank") / F.lit(float(max(lines, 1))))).alias("percentile"))
    )


def flag_unknown_words(
    sentences: DataFrame, vocab: DataFrame, analyser, broadcast_limit: int = BROADCAST_LIMIT_BYTES
) -> DataFrame:
    """Add ``oov``: does any mode-C token have neither its surface nor its normalized form in the vocabulary?

    ``sentences`` must be distinct on ``clean``. With a vocabulary small enough to broadcast, tokens are looked up where
    the duplicate removal left their sentences and counted back into them in the same partitions: no join back, no
    further shuffle. For a larger vocabulary see :func:`unknown_digests`; sentences are then found by digests, so no text
    travels with a token.
    """
    words = vocab.select("word").distinct()
    each = F.array_distinct(analyser.units(F.col("clean")))
    if fits_broadcast(words, broadcast_limit):
        units = sentences.select("*", F.explode_outer(each).alias("unit"))
        listed = units.join(F.broadcast(words.select(F.col("word").alias("_w1"))), analyser.surface(F.col("unit")) == F.col("_w1"), "left")
        form = F.when(F.col("_w1").isNull(), analyser.normalized(F.col("unit")))
        listed = listed.join(F.broadcast(words.select(F.col("word").alias("_w2"))), form == F.col("_w2"), "left")
        unknown = F.col("unit").isNotNull() & F.col("_w1").isNull() & F.col("_w2").isNull()
        return listed.groupBy(*sentences.columns).agg(F.bool_or(unknown).alias("oov"))
    units = sentences.select(digest(F.col("clean")).alias("digest"), F.explode(each).alias("unit"))
    hits = unknown_digests(units, vocab, analyser, broadcast_limit).withColumn("oov", F.lit(True))
    found = sentences.withColumn("digest", digest(F.col("clean"))).join(hits, "digest", "left")
    return found.select(*sentences.columns, F.coalesce("oov", F.lit(False)).alias("oov"))


def digest(text: Column) -> Column:
    return F.unhex(F.md5(text))


def unknown_digests(
    units: DataFrame,
    vocab: DataFrame,
    analyser,
    broadcast_limit: int = BROADCAST_LIMIT_BYTES,
    filter_bytes: int = FILTER_BYTES,
    salts: int = SALTS,
) -> DataFrame:
    """Distinct ``digest`` of the rows of ``units`` (digest, unit) whose unit is in the vocabulary by neither form.

    A small vocabulary is broadcast. Of a larger one the head is, which holds nearly all tokens, and a filter of at most
    ``filter_bytes`` of bits, which settles most others where they are: what it doesn't let through isn't listed, however
    often it occurs. The few it lets through meet the list as distinct units, and what that doesn't know goes back to its
    sentences by a broadcast or, if it is too much, by a join that deals each unit to ``salts`` tasks.
    """
    words = vocab.select("word").distinct()
    if fits_broadcast(words, broadcast_limit):
        return _unknown(units, F.broadcast(words), analyser).select("digest").distinct()
    head = vocab.filter(F.col("rank") < HEAD_WORDS).select("word").distinct()
    if fits_broadcast(head):
        units = _unknown(units, F.broadcast(head), analyser)
    forms = units.withColumns({"_surface": analyser.surface(F.col("unit")), "_normalized": analyser.normalized(F.col("unit"))})
    bits, rows = word_filter(words, filter_bytes)
    for form in ("_surface", "_normalized"):
        forms = _let_through(forms, bits, rows, form)
    passed = (F.col("_surface_passed") | F.col("_normalized_passed")).alias("passed")
    tested = stage_table(forms.select("digest", "unit", passed), "unit-lookups")
    unknown = _unknown(tested.filter("passed").select("unit").distinct(), words, analyser)
    unknown = stage_table(unknown, "unknown-units")
    found = dealt_semi_join(tested.filter("passed"), unknown, "unit", "digest", salts, fits_broadcast(with_forms(unknown, analyser)))
    return tested.filter("not passed").select("digest").unionAll(found.select("digest")).distinct()


def word_filter(words: DataFrame, max_bytes: int = FILTER_BYTES) -> tuple[DataFrame, int]:
    """(row, bits) with the bits of all ``words``, and the number of rows: sixteen bits for each word, up to ``max_bytes``.

    A word sets up to four bits of one 64-bit number; beyond ``max_bytes`` the filter lets more through and stays right.
    """
    numbers = max(1, min(max_bytes // 8, words.count() // 4 + 1))
    rows = -(-numbers // _ROW_WORDS)
    every = words.sparkSession.range(rows * _ROW_WORDS).select((F.col("id") / _ROW_WORDS).cast("int").alias("row"), (F.col("id") % _ROW_WORDS).cast("int").alias("at"), F.lit(0).cast("long").alias("bits"))
    row, at, mask = _bit_places(F.col("word"), rows)
    set_bits = words.filter(F.col("word").isNotNull()).select(row.alias("row"), at.alias("at"), mask.alias("bits"))
    merged = every.unionByName(set_bits).groupBy("row", "at").agg(F.bit_or("bits").alias("bits"))
    packed = merged.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("at", "bits"))).alias("bits"))
    return stage_table(packed.select("row", F.transform("bits", lambda b: b["bits"]).alias("bits")), "word-filter"), rows


def _bit_places(word: Column, rows: int) -> tuple[Column, Column, Column]:
    """(row, place in it, bits) of a word."""
    place = F.pmod(F.xxhash64(word), F.lit(rows * _ROW_WORDS))
    other = F.xxhash64(word, F.lit(1))
    mask = F.lit(0).cast("long")
    for k in range(4):
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(other, 6 * k).bitwiseAND(F.lit(63)).cast("int")))
    return (place / _ROW_WORDS).cast("int"), (place % _ROW_WORDS).cast("int"), mask


def _let_through(units: DataFrame, bits: DataFrame, rows: int, form: str) -> DataFrame:
    row, at, mask = _bit_places(F.col(form), rows)
    side = F.broadcast(bits.select(F.col("row").alias("_row"), F.col("bits").alias("_bits")))  # bounded by word_filter
    passed = F.get("_bits", at).bitwiseAND(mask) == mask
    return units.join(side, row == F.col("_row"), "left").select(*units.columns, F.coalesce(passed, F.lit(False)).alias(f"{form}_passed"))


def dealt_semi_join(rows: DataFrame, few: DataFrame, on: str, spread: str, salts: int, broadcast: bool) -> DataFrame:
    """``rows`` whose ``on`` is in ``few``; without a broadcast, rows of one value go to ``salts`` tasks, by ``spread``."""
    if broadcast:
        return rows.join(F.broadcast(few), on, "left_semi")
    few = few.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    dealt = rows.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    return dealt.join(few, [on, "_salt"], "left_semi").drop("_salt")


def _unknown(units: DataFrame, words: DataFrame, analyser) -> DataFrame:
    """Rows whose ``unit`` is in ``words`` by neither form. Only the remaining surfaces are normalized."""
    by_surface = analyser.surface(F.col("unit")) == F.col("word")
    by_normalized = analyser.normalized(F.col("unit")) == F.col("word")
    return units.join(words, by_surface, "left_anti").join(words, by_normalized, "left_anti")


def attach_percentiles(
    freq: DataFrame, ranked: DataFrame, broadcast_limit: int = BROADCAST_LIMIT_BYTES
) -> DataFrame:
    """Add ``percentile``: by surface, else by normalized form, else null. ``ranked`` is :func:`percentiles`."""
    side = F.broadcast if fits_broadcast(ranked, broadcast_limit) else (lambda df: df)
    by_surface = side(ranked.select(F.col("word").alias("surface"), F.col("percentile").alias("_p1")))
    by_normalized = side(ranked.select(F.col("word").alias("normalized"), F.col("percentile").alias("_p2")))
    return (
        freq.join(by_surface, "surface", "left")
        .join(by_normalized, "normalized", "left")
        .select(*freq.columns, F.coalesce("_p1", "_p2").alias("percentile"))
    )


def absent_words(vocab: DataFrame, freq: DataFrame) -> DataFrame:
    """Vocabulary lines that are neither a surface nor a normalized form of a word with a mode-C count."""
    used = freq.filter(F.col("cnt_c") > 0)
    forms = used.select(F.explode(F.array_distinct(F.array("surface", "normalized"))).alias("word"))
    # Most types of a corpus are in no list: what the filter stops is never shuffled.
    bits, rows = word_filter(vocab.select("word").distinct())
    forms = _let_through(forms, bits, rows, "word").filter("word_passed").select("word").distinct()
    lines = F.lit(float(max(vocab.count(), 1)))
    return vocab.join(forms, "word", "left_anti").select(
        "word", "rank", (100.0 * (1.0 - F.col("rank") / lines)).alias("percentile")
    )
