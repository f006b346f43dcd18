"""File sinks. Large outputs are written in parallel; only bounded lists go to a single file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.functions.rounding import two_decimal_text
from textmill.sources.frequencies import UNKNOWN
from textmill.storage import passing_shuffles

FAST = {"zlib.compress.level": "BEST_SPEED"}
FREQUENCY_HEADER = ("surface", "normalized", "count_A", "count_B", "count_C", "percentile")


def write_corpus(sentences: DataFrame, path: str, files: int | None = None) -> None:
    """gzip text, one sentence per line, under ``split=...``.

    Rows are redistributed first, so files are of one size and none holds a run of like sentences: over ``files``
    tasks, or as many as adaptive execution finds right.
    """
    rows = sentences.select("split", "clean")
    rows = rows.repartition(files) if files else rows.hint("rebalance")
    with passing_shuffles(rows.sparkSession):
        rows.write.partitionBy("split").text(path, compression="gzip")


def percentile_text(percentile: Column) -> Column:
    return F.coalesce(two_decimal_text(percentile), F.lit(UNKNOWN))


def frequency_line() -> Column:
    counts = [F.col(c).cast("string") for c in ("cnt_a", "cnt_b", "cnt_c")]
    return F.concat_ws("\t", "surface", "normalized", *counts, percentile_text(F.col("percentile")))


def write_frequencies(ranked: DataFrame, path: str) -> None:
    """gzip text, tab-separated rows in rank order across the part files, under ``split=...``; the header is a table beside it.

    Word forms hold no line breaks (they are flattened when counted), and no data line can pass for a comment.
    """
    rows = ranked.repartitionByRange("split", "rank").sortWithinPartitions("split", "rank")
    with passing_shuffles(rows.sparkSession):
        rows.select("split", frequency_line().alias("line")).write.options(**FAST).partitionBy("split").text(path, compression="gzip")
    header = ranked.sparkSession.createDataFrame([("\t".join(FREQUENCY_HEADER),)], "line string")
    header.coalesce(1).write.text(f"{path}_header")


def write_small_text(rows: DataFrame, path: str, text_col: str = "text") -> None:
    """One file per split of a sample, whose size is fixed by its operator."""
    by_split = "split" in rows.columns
    columns = ["split", text_col] if by_split else [text_col]
    writer = rows.select(*columns).coalesce(1).write
    with passing_shuffles(rows.sparkSession):
        (writer.partitionBy("split") if by_split else writer).text(path)


def write_metadata(metadata: DataFrame, path: str) -> None:
    with passing_shuffles(metadata.sparkSession):
        metadata.coalesce(1).write.json(path)


def write_counts(counted: DataFrame, path: str) -> None:
    """``word<TAB>count`` for a whole list, most frequent first across the part files."""
    order = [F.desc("cnt"), F.asc("surface")]
    line = F.concat_ws("\t", "surface", F.col("cnt").cast("string"))
    with passing_shuffles(counted.sparkSession):
        counted.orderBy(*order).select(line.alias("line")).write.text(path)
