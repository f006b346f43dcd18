"""Words whose observed frequency rank differs most from their rank in the vocabulary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.functions.rounding import two_decimals
from textmill.operators.freq import frequency_order
from textmill.operators.rank import global_rank, top_n

# Fixed values.
MIN_COUNT = 100
REPORT_ROWS = 20


def eligible(freq: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    return freq.filter(
        F.col("percentile").isNotNull() & (F.col("cnt_c") >= min_count) & (F.col("surface") == F.col("normalized"))
    )


def percentile_gaps(freq: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """Observed percentile of each eligible word, its listed one (two decimals) and the gap between them."""
    ranked = global_rank(eligible(freq, min_count).drop("rank"), frequency_order(), out="_rank")
    total = F.lit(float(max(ranked.count(), 1)))
    listed = two_decimals(F.col("percentile"))
    observed = 100.0 * (1.0 - (F.col("_rank") - 1) / total)
    return ranked.select(
        "surface",
        "cnt_c",
        observed.alias("observed"),
        listed.alias("listed"),
        (observed - listed).alias("gap"),
        F.abs(observed - listed).alias("abs_gap"),
    )


def largest_gaps(gaps: DataFrame, n: int = REPORT_ROWS) -> DataFrame:
    return top_n(gaps, [F.desc("abs_gap"), F.asc("surface")], n)
