"""Documents to lines to chunks. Sentences never cross a line or a chunk, so every later step is chunk-local."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.functions.chars import strip

# The input limit of a known morphological analyser; a line above it is cut into chunks of so many
# characters. Which limit holds, if any, is a property of the analyser in use.
MAX_LINE_BYTES = 49_000
CHUNK_CHARS = 10_000


def stripped_lines(text: Column) -> Column:
    """Array of (line_no, line): split at line feeds, strip, drop empty lines. Numbers count all lines from 0."""
    numbered = F.transform(
        F.split(text, "\n"), lambda line, i: F.struct(i.alias("line_no"), strip(line).alias("line"))
    )
    return F.filter(numbered, lambda x: x["line"] != "")


def line_chunks(line: Column, max_bytes: int | None = MAX_LINE_BYTES, chunk_chars: int = CHUNK_CHARS) -> Column:
    """Array of chunks: the line itself, or fixed-size pieces where it is too long in UTF-8 bytes (None: never)."""
    if max_bytes is None:
        return F.array(line)
    starts = F.sequence(F.lit(1), F.length(line), F.lit(chunk_chars))
    pieces = F.transform(starts, lambda i: F.substring(line, i, F.lit(chunk_chars)))
    return F.when(F.octet_length(line) > max_bytes, pieces).otherwise(F.array(line))


def explode_lines(docs: DataFrame) -> DataFrame:
    """One row per non-empty line. Null texts give none."""
    return docs.select("source", "doc_id", F.inline(stripped_lines(F.col("text"))))


def explode_chunks(
    docs: DataFrame, max_bytes: int | None = MAX_LINE_BYTES, chunk_chars: int = CHUNK_CHARS
) -> DataFrame:
    chunks = line_chunks(F.col("line"), max_bytes, chunk_chars)
    return explode_lines(docs).select(
        "source", "doc_id", "line_no", F.posexplode(chunks).alias("chunk_no", "chunk")
    )
