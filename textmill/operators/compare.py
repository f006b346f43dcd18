"""Comparison of the two splits' vocabularies. Input: the collapsed frequency table, one row per split and surface."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.operators.rank import top_n
from textmill.operators.split import TRAIN, VALIDATION

REPORT_ROWS = 50  # fixed value


def split_words(collapsed: DataFrame) -> DataFrame:
    """One row per surface with its mode-C count and percentile in each split; a count of 0 means absent."""

    def side(split: str, name: str) -> list[Column]:
        here = F.col("split") == split
        return [
            F.coalesce(F.sum(F.when(here, F.col("cnt_c"))), F.lit(0)).alias(f"cnt_{name}"),
            F.max(F.when(here, F.col("percentile"))).alias(f"pct_{name}"),
        ]

    return (
        collapsed.filter(F.col("cnt_c") > 0)
        .groupBy("surface")
        .agg(*side(TRAIN, "train"), *side(VALIDATION, "val"))
    )


def _divide(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def topography(words: DataFrame) -> DataFrame:
    """One row: sizes of the union, the intersection and both differences."""
    t, v = F.col("cnt_train") > 0, F.col("cnt_val") > 0
    return words.agg(
        F.count_if(t | v).alias("union_size"),
        F.count_if(t & v).alias("shared"),
        F.count_if(t & ~v).alias("only_train"),
        F.count_if(v & ~t).alias("only_val"),
    )


def similarity(words: DataFrame, vocab_size: int) -> DataFrame:
    """One row with every figure of the report, from a single pass over the words."""
    t, v = F.col("cnt_train").cast("double"), F.col("cnt_val").cast("double")
    in_t, in_v = t > 0, v > 0
    known_t, known_v = in_t & F.col("pct_train").isNotNull(), in_v & F.col("pct_val").isNotNull()
    sums = words.agg(
        F.count_if(in_t | in_v).alias("union_size"),
        F.count_if(in_t & in_v).alias("shared"),
        F.count_if(in_t).alias("train_size"),
        F.count_if(in_v).alias("val_size"),
        F.count_if(known_t).alias("train_known"),
        F.count_if(known_v).alias("val_known"),
        F.sum(t * v).alias("dot"),
        F.sqrt(F.sum(t * t)).alias("norm_t"),
        F.sqrt(F.sum(v * v)).alias("norm_v"),
    )

    def listed(side: str) -> Column:
        size, known = F.col(f"{side}_size"), F.col(f"{side}_known")
        return F.when(size > 0, _divide(known, size + F.lit(vocab_size) - known)).otherwise(0.0)

    return sums.select(
        "union_size",
        "shared",
        (F.col("train_size") - F.col("shared")).alias("only_train"),
        (F.col("val_size") - F.col("shared")).alias("only_val"),
        _divide(F.col("shared"), F.col("union_size")).alias("jaccard"),
        _divide(F.col("dot"), F.col("norm_t") * F.col("norm_v")).alias("cosine"),
        listed("train").alias("jaccard_train_vocab"),
        listed("val").alias("jaccard_val_vocab"),
        _divide(F.col("train_known"), F.col("train_size")).alias("coverage_train"),
        _divide(F.col("val_known"), F.col("val_size")).alias("coverage_val"),
    )


def only_in(words: DataFrame, split: str) -> DataFrame:
    """(surface, cnt) of the words one split has alone."""
    here, there = ("cnt_train", "cnt_val") if split == TRAIN else ("cnt_val", "cnt_train")
    return words.filter((F.col(here) > 0) & (F.col(there) == 0)).select("surface", F.col(here).alias("cnt"))


def unknown_in(words: DataFrame, split: str) -> DataFrame:
    """(surface, cnt) of a split's words without a percentile."""
    side = "train" if split == TRAIN else "val"
    return words.filter((F.col(f"cnt_{side}") > 0) & F.col(f"pct_{side}").isNull()).select(
        "surface", F.col(f"cnt_{side}").alias("cnt")
    )


def most_frequent(counted: DataFrame, n: int = REPORT_ROWS) -> DataFrame:
    return top_n(counted, [F.desc("cnt"), F.asc("surface")], n)


def union_words(collapsed: DataFrame) -> DataFrame:
    """Words of either split with flags: the set operations of the two vocabularies."""
    words = split_words(collapsed)
    t, v = F.col("cnt_train") > 0, F.col("cnt_val") > 0
    return words.select("surface", t.alias("in_train"), v.alias("in_val"), (t & v).alias("in_both"))
