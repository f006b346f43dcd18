"""Documents to rated sentences: segmentation, structure rules, cleaning and density, without a shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.functions import chars
from textmill.functions.chars import strip
from textmill.functions.cleaning import clean_sentence
from textmill.operators.lines import CHUNK_CHARS, explode_chunks, explode_lines
from textmill.operators.runs import density
from textmill.operators.scan import BLOCK
from textmill.operators.segment import join_pieces, split_sentences, structure_fault
from textmill.storage import stage_table

MIN_DENSITY = 0.75  # fixed value
ORDINALS = ("line_no", "chunk_no", "sent_no")
LONG_BYTES = 4 << 20  # a build that finds longer texts segments their lines in pieces
PIECE_CHARS = 20_000


def segment_documents(
    docs: DataFrame,
    analyser,
    max_bytes: int | None = None,
    chunk_chars: int = CHUNK_CHARS,
    long_bytes: int | None = None,
    piece_chars: int = PIECE_CHARS,
) -> DataFrame:
    """One row per sentence: ``raw``, ``fault`` (first structural rule broken) and ``orig_chars``.

    ``orig_chars`` holds the chunk's Japanese characters on its first row and 0 on the others, so its sum over any set
    of whole documents is their count: stripping and splitting only remove whitespace. A chunk the analyser failed on
    is one row with the fault ``analyser_error``. Blank sentences stay, with an empty ``raw``. Lines are cut where they
    exceed ``max_bytes`` or, without it, the analyser's own ``max_line_bytes``; most have none and read whole lines. These,
    in texts above ``long_bytes`` if given (which reads the documents once more at the call), are segmented in pieces of ``piece_chars`` with the same result, but for ``orig_chars``:
    each piece has its own on the sentence it begins in.
    """
    limit = analyser.max_line_bytes if max_bytes is None else max_bytes
    if limit is not None or long_bytes is None:
        return _segment_chunks(docs, analyser, limit, chunk_chars)
    # A null text has no lines. A filter would compute the texts of the input twice.
    short = docs.withColumn("text", F.when(F.octet_length("text") <= long_bytes, F.col("text")))
    short = _segment_chunks(short, analyser, None, chunk_chars)
    pieces = stage_table(_pieces(docs.filter(F.octet_length("text") > long_bytes), analyser, piece_chars), "long-lines")
    return short if pieces.isEmpty() else short.unionByName(_segment_pieces(pieces))


PIECE_KEYS = ("source", "doc_id", "line_no", "chunk_no", "failed")


def _pieces(docs: DataFrame, analyser, piece_chars: int) -> DataFrame:
    """Long lines as annotated pieces. They are dealt to tasks one by one, so no task holds a line's tokens."""
    pieces = explode_lines(docs).select(
        "source", "doc_id", "line_no", F.posexplode(analyser.pieces(F.col("line"), piece_chars)).alias("piece_no", "chunk")
    )
    pieces = pieces.repartition("source", "doc_id", "line_no", "piece_no")
    found = analyser.annotate(pieces.withColumn("extra", chars.japanese_chars(F.col("chunk")).cast("long")), "chunk")
    failed = F.col("flags").isNull()
    return found.select(
        *PIECE_KEYS[:3],
        F.lit(0).alias("chunk_no"),
        failed.alias("failed"),
        "piece_no",
        F.when(failed, F.array("chunk")).otherwise(F.col("surfaces")).alias("surfaces"),
        F.when(failed, F.array(F.lit(0))).otherwise(F.col("flags")).alias("flags"),
        "extra",
    )


def _segment_pieces(pieces: DataFrame, block: int = BLOCK) -> DataFrame:
    return join_pieces(pieces, list(PIECE_KEYS), block).select(
        *PIECE_KEYS[:4],
        "sent_no",
        F.col("text").alias("raw"),
        F.when(F.col("failed"), "analyser_error").otherwise(structure_fault(F.col("text"), F.col("flags"))).alias("fault"),
        F.col("extra").alias("orig_chars"),
    )


def _segment_chunks(docs: DataFrame, analyser, max_bytes: int | None, chunk_chars: int) -> DataFrame:
    chunk = F.col("chunk")
    chunks = explode_chunks(docs, max_bytes, chunk_chars)
    if hasattr(analyser, "segments"):  # an analyser that finds them without an array of tokens
        found = chunks.select("*", F.posexplode(analyser.segments(chunk)).alias("sent_no", "segment"))
        sentence, failed = F.col("segment.sentence"), F.col("segment.fault") == "analyser_error"
        return found.select(
            "source",
            "doc_id",
            "line_no",
            "chunk_no",
            "sent_no",
            F.when(failed, sentence).otherwise(strip(sentence)).alias("raw"),
            F.col("segment.fault").alias("fault"),
            F.col("segment.japanese").alias("orig_chars"),
        )
    chunks = chunks.withColumn("_chunk_chars", chars.japanese_chars(chunk).cast("long"))
    analysed = (
        analyser.annotate(chunks, "chunk")
        .withColumn("_failed", F.when(F.col("flags").isNull(), chunk))
        .drop("chunk")
    )
    text, failed = F.col("text"), F.col("_failed")
    number = F.coalesce("sent_no", F.lit(0))
    return split_sentences(analysed).select(
        "source",
        "doc_id",
        "line_no",
        "chunk_no",
        number.alias("sent_no"),
        F.coalesce(failed, text, F.lit("")).alias("raw"),
        F.when(failed.isNotNull(), "analyser_error").otherwise(structure_fault(text, F.col("flags"))).alias("fault"),
        F.when(number == 0, F.col("_chunk_chars")).otherwise(F.lit(0)).alias("orig_chars"),
    )


def rate_sentences(sentences: DataFrame, min_density: float = MIN_DENSITY) -> DataFrame:
    """Add ``clean``, ``density``, ``kept_chars``, ``reject_reason`` and ``status`` (accepted, rejected or blank).

    ``clean`` is null for a sentence that never reaches cleaning. ``kept_chars`` counts accepted sentences, copies
    included. The verdict leaves through a one-element array: without it a later filter on ``status`` would move below
    the projections and repeat the whole cleaning inside its condition.
    """
    raw, clean = F.col("raw"), F.col("clean")
    early = F.coalesce(
        F.col("fault"),
        F.when(~chars.starts_valid(raw), "bad_start").when(~chars.contains_kana(raw), "no_kana"),
    )
    reason = F.coalesce(F.col("early"), F.when(F.col("density") < min_density, "low_density"))
    status = (
        F.when(raw == "", "blank").when(F.col("reject_reason").isNull(), "accepted").otherwise("rejected")
    )
    verdict = ["clean", "density", "reject_reason", "status"]
    keep = [c for c in sentences.columns if c != "fault"]
    kept = F.when(F.col("status") == "accepted", chars.japanese_chars(clean)).otherwise(F.lit(0)).cast("long")
    return (
        sentences.withColumn("early", early)
        .withColumn("clean", F.when(F.col("early").isNull() & (raw != ""), clean_sentence(raw)))
        .withColumn("density", F.when(clean.isNotNull(), density(clean)))
        .withColumn("reject_reason", F.when(raw != "", reason))
        .withColumn("status", status)
        .select(*keep, F.inline(F.array(F.struct(*verdict))))
        .withColumn("kept_chars", kept)  # behind the array, so a query that doesn't read it doesn't compute it
    )


def extract_sentences(docs: DataFrame, analyser, **limits) -> DataFrame:
    return rate_sentences(segment_documents(docs, analyser, **limits))
