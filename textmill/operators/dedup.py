"""Duplicate removal. Every aggregate combines copies inside the map tasks before anything is shuffled."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.operators.extract import ORDINALS


def accepted(extracted: DataFrame) -> DataFrame:
    return extracted.filter(F.col("status") == "accepted")


def dedup_in_document(extracted: DataFrame) -> DataFrame:
    """The first copy of each clean sentence in each document."""
    return (
        accepted(extracted)
        .groupBy("source", "doc_id", "clean")
        .agg(F.min(F.struct(*ORDINALS)).alias("first"))
        .select("source", "doc_id", "first.*", "clean")
    )


def distinct_sentences(extracted: DataFrame) -> DataFrame:
    """Each clean sentence once over all documents: a hash aggregate on the sentence and nothing else.

    An accepted sentence is never null; saying so gives every branch of a later join the same scan, and Spark then
    runs the shuffle once for all of them.
    """
    return accepted(extracted).filter(F.col("clean").isNotNull()).select("clean").distinct()


def first_copies(extracted: DataFrame) -> DataFrame:
    """Each clean sentence with the place of its first copy and the number of copies."""
    return (
        accepted(extracted)
        .groupBy("clean")
        .agg(F.min(F.struct("source", "doc_id", *ORDINALS)).alias("first"), F.count(F.lit(1)).alias("copies"))
        .select("clean", "first.*", "copies")
    )
