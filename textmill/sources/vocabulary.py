"""Ranked word lists as ``vocab(word, rank)``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.functions.chars import strip
from textmill.operators.rank import global_rank

VOCAB = T.StructType([T.StructField("word", T.StringType()), T.StructField("rank", T.LongType())])


def read_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """UTF-8 text with one word per line, most frequent first; blank lines do not count.

    The rank is the line's place in the file, and of several files in the order of their paths. A block of a file is
    read by one task from front to back, so a line's place is its file, the start of its block and its place among the
    rows of the task; ranks follow that order over all tasks.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    placed = lines.select(
        strip(F.col("value")).alias("word"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"),
    )
    order = [F.asc("_file"), F.asc("_block"), F.asc("_line")]
    ranked = global_rank(placed.filter(F.col("word") != ""), order)
    return ranked.select("word", (F.col("rank") - 1).alias("rank"))


def read_vocabulary_table(spark: SparkSession, path: str) -> DataFrame:
    """A parquet table that already has ``word`` and ``rank``."""
    return spark.read.schema(VOCAB).parquet(path)
