"""Mixing sources to target weights by systematic sampling.

Every document of a source has the same expected number of copies, target / source size. Their prefix sum within the
source, plus one random offset of the source, crosses an integer boundary once per copy to emit. Documents are walked
from the longest to the shortest, so boundaries fall evenly over all lengths and the words taken stay within about one
document of the target.

The prefix sum is the document's exact place in its source times the rate, so it doesn't depend on partitioning and
reruns agree. Places come from range partitions and a table of counts, so a source with a third of all documents is
walked by many tasks. Only sizes and ids are shuffled.

Edge cases: null and empty texts have size 0 and take nothing; a null source is one source, last in order; a source
without words has target 0; repeated rows are documents of their own; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmill.llm.common import n_words, pick
from textmill.operators.rank import global_rank

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
SEED = "mix-1"


def source_key(source: Column) -> Column:
    """Orders as the source by code point, null last, and is never null."""
    return F.coalesce(F.concat(F.lit("1"), source), F.lit("2"))


def targets(sizes: DataFrame, weights: Sequence[int], max_copies: int) -> DataFrame:
    """Target of each source: all words shared by weight, no source above ``max_copies`` times its size.

    The excess of capped sources is reshared by weight until none is above. Sources are capped in the order of cap per
    weight, so the level (words per unit of weight) for the rest is known from running sums, and the first source that
    the level doesn't fill ends the capping. ``sizes`` has one row per source, as many as a mixture names, so windows
    over all of it are small.
    """
    by_key = Window.orderBy("key")
    weight = F.element_at(
        F.array(*map(F.lit, weights)), ((F.row_number().over(by_key) - 1) % len(weights) + 1).cast("int")
    )
    all_rows = Window.orderBy("fill", "key").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = Window.orderBy("fill", "key").rowsBetween(Window.unboundedPreceding, -1)
    onward = Window.orderBy("fill", "key").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    caps = (
        sizes.withColumn("weight", weight)
        .withColumn("cap", F.col("source_size") * max_copies)
        .withColumn("fill", F.col("cap") / F.col("weight"))
    )
    capped = F.coalesce(F.sum("cap").over(before), F.lit(0))
    level = (F.sum("source_size").over(all_rows) - capped) / F.sum("weight").over(onward)
    levels = caps.withColumn("level", level).withColumn(
        "level", F.min(F.when(F.col("level") <= F.col("fill"), F.struct("fill", "key", "level"))).over(all_rows)["level"]
    )
    return levels.select(
        "key", "source_size", F.least(F.col("cap").cast("double"), F.col("weight") * F.col("level")).alias("target")
    )


def offset(key: Column, seed: str) -> Column:
    """A number in [0, 1) drawn for each source: the first 32 bits of an md5."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(seed), key)), 1, 8), 16, 10).cast("double") / 2.0**32


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = WEIGHTS,
    max_copies: int = MAX_COPIES,
    seed: str = SEED,
) -> DataFrame:
    """One row per row of ``docs``: id, key of its source, content (hash of its text), size, source_size, target of its
    source, copies and taken words."""
    sized = pick(docs, id=id_col, text=text_col, source=source_col).select(
        "id",
        source_key(F.col("source")).alias("key"),
        F.xxhash64("text").alias("content"),
        n_words(F.col("text")).alias("size"),
    )
    ranked = global_rank(sized, [F.desc("size"), F.asc("id"), F.asc("content")], ["key"], "place")
    sources = ranked.groupBy("key").agg(F.sum("size").alias("source_size"))
    plan = targets(sources, weights, max_copies).select(F.col("key").alias("_key"), "source_size", "target")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    crossed = lambda place: F.floor(place * rate + offset(F.col("key"), seed))
    copies = F.least(crossed(F.col("place")) - crossed(F.col("place") - 1), F.lit(max_copies))
    return (
        ranked.join(F.broadcast(plan), F.col("key") == F.col("_key"))  # one row per source
        .withColumn("copies", copies)
        .select(*sized.columns, "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
    )


def emit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: each row of ``docs`` as often as :func:`mix` takes it, with ``copy`` counting from 1 (in place of
    a column of that name). Equal rows get their copies together.
    """
    taken = mix(docs, id_col, text_col, source_col).groupBy("id", "key", "content").agg(F.sum("copies").alias("_copies"))
    taken = taken.filter("_copies > 0").select(
        F.col("id").alias("_id"), F.col("key").alias("_key"), F.col("content").alias("_content"), "_copies"
    )
    found = {
        "_m_id": F.col(f"`{id_col}`"),
        "_m_key": source_key(F.col(f"`{source_col}`")),
        "_m_content": F.xxhash64(F.col(f"`{text_col}`")),
    }
    once = docs.withColumns(found).dropDuplicates(list(found))
    same = F.col("_m_id").eqNullSafe(F.col("_id")) & (F.col("_m_key") == F.col("_key"))
    both = once.join(taken, same & (F.col("_m_content") == F.col("_content")))
    return both.select(*(c for c in docs.columns if c != "copy"), F.explode(F.sequence(F.lit(1), "_copies")).alias("copy"))
