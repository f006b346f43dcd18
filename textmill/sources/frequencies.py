"""Frequency tables read back from tab-separated text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UNKNOWN = "x"
HEADER_ROWS = 3  # fixed value


def read_frequencies(
    spark: SparkSession, path: str, min_fields: int = 5, drop_hash_rows: bool = False
) -> DataFrame:
    """surface, normalized, counts A, B, C and an optional percentile (``x`` or absent: null).

    Lines with fewer fields or without a numeric mode-C count are skipped (:func:`count_bad_lines` counts them).
    ``drop_hash_rows`` also skips the header of files that carry it inside: lines that begin with ``#`` in the first
    ``HEADER_ROWS`` places of a file. A word may begin with ``#`` as well, and stays anywhere else. A folder with both splits gives their ``split`` as a column, too.
    """
    lines = _lines(spark, path, drop_hash_rows)
    return (
        lines.filter(_good(min_fields))
        .select(
            *(c for c in lines.columns if c == "split"),
            F.get("f", F.lit(0)).alias("surface"),
            F.get("f", F.lit(1)).alias("normalized"),
            F.get("f", F.lit(2)).try_cast("long").alias("cnt_a"),
            F.get("f", F.lit(3)).try_cast("long").alias("cnt_b"),
            F.get("f", F.lit(4)).try_cast("long").alias("cnt_c"),
            F.get("f", F.lit(5)).try_cast("double").alias("percentile"),
        )
    )


def count_bad_lines(spark: SparkSession, path: str, min_fields: int = 5, drop_hash_rows: bool = False) -> int:
    """How many lines :func:`read_frequencies` skips for their form."""
    return _lines(spark, path, drop_hash_rows).filter(~_good(min_fields)).count()


def _lines(spark: SparkSession, path: str, drop_hash_rows: bool) -> DataFrame:
    lines = spark.read.option("lineSep", "\n").text(path)
    if drop_hash_rows:
        columns = lines.columns
        # A task reads the blocks of files from front to back, so a line's place follows from the first line's number.
        placed = lines.select(
            "*",
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_line"),
        )
        first = placed.filter(F.col("_block") == 0).groupBy("_file").agg(F.min("_line").alias("_first"))
        header = F.startswith("value", F.lit("#")) & (F.col("_block") == 0) & (F.col("_line") < F.col("_first") + HEADER_ROWS)
        lines = placed.join(first, "_file").filter(~header).select(*columns)
    return lines.withColumn("f", F.split("value", "\t"))


def _good(min_fields: int) -> Column:
    return (F.size("f") >= min_fields) & F.get("f", F.lit(4)).try_cast("long").isNotNull()
