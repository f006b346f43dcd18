"""Run statistics: retention, rejects and samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.functions.chars import contains_any
from textmill.operators.extract import ORDINALS
from textmill.operators.rank import near_digest_end, top_n
from textmill.operators.split import SPLITS

# Fixed values.
WATCH_WORDS = ("2022", "2023", "⭐", "▶")
SAMPLE_SIZE = 100
WATCH_SAMPLE_SIZE = 500


def _ratio(kept: Column, orig: Column) -> Column:
    return F.coalesce(F.try_divide(kept.cast("double"), orig.cast("double")), F.lit(0.0))


def document_retention(extracted: DataFrame) -> DataFrame:
    """Original and kept Japanese characters per document."""
    return extracted.groupBy("source", "doc_id").agg(
        F.sum("orig_chars").alias("orig_chars"), F.sum("kept_chars").alias("kept_chars")
    )


def retention(extracted: DataFrame) -> DataFrame:
    """One row: the sums over all documents and their ratio, 0 if there is nothing."""
    sums = extracted.agg(
        F.coalesce(F.sum("orig_chars"), F.lit(0)).alias("orig_chars"),
        F.coalesce(F.sum("kept_chars"), F.lit(0)).alias("kept_chars"),
    )
    return sums.withColumn("ratio", _ratio(F.col("kept_chars"), F.col("orig_chars")))


def reject_reasons(rejects: DataFrame) -> DataFrame:
    return rejects.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("sentences"))


def reject_pool(extracted: DataFrame, flagged: DataFrame) -> DataFrame:
    """Rejects of the extraction (raw, copies kept) and of the vocabulary filter (clean, distinct)."""
    place = F.concat_ws(":", "source", "doc_id", *ORDINALS)
    early = extracted.filter(F.col("status") == "rejected").select(
        F.col("raw").alias("text"), "reject_reason", place.alias("place")
    )
    late = flagged.filter("oov").select(
        F.col("clean").alias("text"), F.lit("oov").alias("reject_reason"), F.lit("").alias("place")
    )
    return early.unionByName(late)


def watched(rejects: DataFrame, words=WATCH_WORDS) -> DataFrame:
    return rejects.filter(contains_any(F.col("text"), words))


def uniform_sample(rows: DataFrame, key: list[str], n: int = SAMPLE_SIZE, seed: int = 0, by=()) -> DataFrame:
    """``n`` rows in the order of a seeded hash of ``key``, which must be unique: uniform and repeatable.

    ``rows`` is read twice, once for counts, and only rows near the bound they give are sorted.
    """
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *key))
    order = [F.asc("_digest"), *(F.asc(c) for c in key)]
    near = near_digest_end(rows.withColumn("_digest", digest), n, by)
    return top_n(near, order, n, by).drop("_digest")


def sample_per_split(rejects: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """One sample for each split, drawn independently from the one pool the splits share."""
    offered = rejects.withColumn("split", F.explode(F.array(*map(F.lit, SPLITS))))
    return uniform_sample(offered, ["split", "place", "text"], n, seed, ["split"])


def top_by_text(rows: DataFrame, n: int = SAMPLE_SIZE, text_col: str = "clean") -> DataFrame:
    """The ``n`` largest texts in code-point order; each task keeps its own ``n`` in a heap."""
    return rows.orderBy(F.desc(text_col)).limit(n)


def split_metadata(sentences: DataFrame, retained: float, sources: dict[str, str]) -> DataFrame:
    """One row per split, empty splits included, from one pass. ``sources`` maps names to paths.

    The retention ratio covers all documents and is the same for each split.
    """
    counts = [F.count_if(F.col("split") == s).alias(s) for s in SPLITS]
    per_split = [F.struct(F.lit(s).alias("split"), F.col(s).alias("sentence_count")) for s in SPLITS]
    return (
        sentences.agg(*counts)
        .select(F.inline(F.array(*per_split)))
        .withColumn("kanji_kana_retention_ratio", F.round(F.lit(float(retained)), 6))
        .withColumn("source", F.lit(", ".join(sources)))
        .withColumn("base", F.lit(", ".join(sources.values())))
    )
