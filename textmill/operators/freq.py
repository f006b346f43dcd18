"""Token frequencies at three granularities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.operators.rank import at_least_n, global_rank
from textmill.operators.tokens import MODES, explode_units, with_forms
from textmill.storage import drop_table, stage_table


def frequency_order():
    """Total order of a frequency table: counts C, B, A descending, then the forms."""
    return [F.desc("cnt_c"), F.desc("cnt_b"), F.desc("cnt_a"), F.asc("surface"), F.asc("normalized")]


def token_frequencies(sentences: DataFrame, analyser, by=("split",), text_col: str = "clean") -> DataFrame:
    """Counts per (surface, normalized) in modes A, B and C: one pass, one shuffle, never a missing count.

    Sentences that come with their ``tokens`` are not analysed again.
    """
    source = "tokens" if "tokens" in sentences.columns else text_col
    if source == text_col and hasattr(analyser, "counted_units"):
        units = analyser.counted_units(sentences.select(*by, text_col), by, text_col)
        counts = [F.sum(f"cnt_{mode.lower()}").alias(f"cnt_{mode.lower()}") for mode in MODES]
    else:
        units = explode_units(sentences.select(*by, source), analyser, text_col=text_col)
        counts = [F.count_if(F.col("mode") == mode).alias(f"cnt_{mode.lower()}") for mode in MODES]
    counted = with_forms(units.groupBy(*by, "unit").agg(*counts), analyser)
    return counted.select(*by, "surface", "normalized", "cnt_a", "cnt_b", "cnt_c")


def top_types(freq: DataFrame, n: int | None = None, by=("split",)) -> DataFrame:
    """The rows of each split with their ``rank``, or the ``n`` most frequent.

    The counts are staged, as ranks read them twice: to find the bounds of the ranges, and to sort them. For ``n``, a
    histogram of mode-C counts says which types can be among them, and only these are sorted.
    """
    freq = stage_table(freq, "types")
    found = freq if n is None else at_least_n(freq, "cnt_c", n, by)
    ranked = global_rank(found, frequency_order(), by)
    drop_table(freq)  # ranks are read from their own table
    return ranked if n is None else ranked.filter(F.col("rank") <= n)


def collapse_surface(freq: DataFrame, by=("split",)) -> DataFrame:
    """One row per surface: counts added up, normalized form and percentile of its most frequent row."""
    best = F.min(
        F.struct(
            (-F.col("cnt_c")).alias("c"),
            (-F.col("cnt_b")).alias("b"),
            (-F.col("cnt_a")).alias("a"),
            "normalized",
            "percentile",
        )
    )
    sums = [F.sum(c).alias(c) for c in ("cnt_a", "cnt_b", "cnt_c")]
    return (
        freq.groupBy(*by, "surface")
        .agg(*sums, best.alias("best"))
        .select(*by, "surface", "best.normalized", "cnt_a", "cnt_b", "cnt_c", "best.percentile")
    )
