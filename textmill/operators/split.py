"""Train and validation by a stable hash of the sentence: a sentence never changes sides between runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPLITS = TRAIN, VALIDATION = ("train", "validation")


def hash_bucket(text: Column) -> Column:
    """0..999 from the first 32 bits of the md5 digest."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % 1000


def with_split(sentences: DataFrame, val_ratio: float = 0.1, text_col: str = "clean") -> DataFrame:
    is_validation = hash_bucket(F.col(text_col)) < F.lit(val_ratio * 1000.0)
    return sentences.withColumn("split", F.when(is_validation, VALIDATION).otherwise(TRAIN))
