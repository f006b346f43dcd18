"""Exact global ranks and large top-n lists without pulling rows into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmill.storage import stage_table

# Lists up to this long are merged from the tasks' own lists; beyond it ranks are global. Spark applies a row_number
# limit inside the map tasks up to the same bound (spark.sql.optimizer.windowGroupLimitThreshold).
MAX_MERGED_ROWS = 1_000

MAX_BROADCAST_OFFSETS = 100_000

_MERGE_GROUPS = 1_024

_ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number within the partition below


def global_rank(df: DataFrame, order: Sequence[Column], group: Sequence[str] = (), out: str = "rank") -> DataFrame:
    """Add the 1-based position of each row under a total order, per group if given.

    Rows are range-partitioned and sorted; a row's rank is its place in its partition plus the rows its group has in
    earlier partitions. The order must be total, so that range partitioning can split any tie and a recomputed task
    finds the same places. The table of counts has at most one row per partition and group boundary.
    """
    keys = [F.asc(c) for c in group] + list(order)
    placed = (
        df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_id", F.monotonically_increasing_id())
    )
    placed = (
        stage_table(placed, "ranked")
        .withColumn("_part", F.shiftright("_id", _ROW_BITS))
        .withColumn("_row", F.col("_id") - F.shiftleft(F.col("_part"), _ROW_BITS))
        .drop("_id")
    )
    by = ["_part", *group]
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    offsets = counts.select(
        *by, (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_offset")
    )
    # Without groups there is a row per partition. Groups may be many, so their rows are counted first.
    offsets = stage_table(offsets, "offsets") if group else offsets
    small = not group or offsets.count() <= MAX_BROADCAST_OFFSETS
    return (
        placed.join(F.broadcast(offsets) if small else offsets, by)
        .withColumn(out, F.col("_offset") + F.col("_row") + 1)
        .drop("_part", "_row", "_offset")
        .select(*df.columns, out)
    )


def top_n(df: DataFrame, order: Sequence[Column], n: int, group: Sequence[str] = ()) -> DataFrame:
    """The first ``n`` rows under a total order, per group if given.

    For a small ``n`` every task keeps its own first ``n`` rows, groups of tasks merge theirs, and the groups' lists
    are merged last, so no task ever sees more than a few hundred lists. A large ``n`` needs :func:`global_rank`.
    """
    if n > MAX_MERGED_ROWS:
        return global_rank(df, order, group, "_rank").filter(F.col("_rank") <= n).drop("_rank")
    merged = _first(df.withColumn("_merge", F.spark_partition_id() % _MERGE_GROUPS), order, n, [*group, "_merge"])
    merged = merged.drop("_merge")
    return _first(merged, order, n, group) if group else merged.orderBy(*order).limit(n)


def at_least_n(df: DataFrame, count: str, n: int, group: Sequence[str] = ()) -> DataFrame:
    """The rows of each group whose ``count`` is no smaller than that of its ``n``-th largest.

    Different counts are few, as their sum is bounded by the total: a trillion tokens have at most 1.4 million. ``df`` is
    read twice, and its groups must be as few as splits are.
    """
    counts = df.groupBy(*group, count).agg(F.count(F.lit(1)).alias("_n"))
    down = Window.partitionBy(*group).orderBy(F.desc(count))
    reached = counts.withColumn("_sum", F.sum("_n").over(down)).filter(F.col("_sum") >= n)
    least = reached.groupBy(*group).agg(F.max(count).alias("_least")).filter(F.col("_least").isNotNull()).collect()
    below = F.lit(False)
    for row in least:
        mine = F.col(count) < row["_least"]
        for name in group:
            mine &= F.col(name).eqNullSafe(F.lit(row[name]))
        below |= mine
    return df.filter(~below)


def near_digest_end(df: DataFrame, n: int, group: Sequence[str] = (), largest: bool = False) -> DataFrame:
    """The rows whose hex ``_digest`` lies in the first (or last) part of the range that holds ``n`` rows per group.

    Digests are uniform, so counts of their first four digits say how far that part reaches; one pass counts, and the
    rows kept are few more than asked for. ``df`` is read twice, and its groups must be as few as splits are.
    """
    prefix = F.substring("_digest", 1, 4)
    counts = df.groupBy(*group, prefix.alias("_prefix")).agg(F.count(F.lit(1)).alias("_n"))
    ordered = Window.partitionBy(*group).orderBy(F.desc("_prefix") if largest else F.asc("_prefix"))
    reached = counts.withColumn("_sum", F.sum("_n").over(ordered)).filter(F.col("_sum") >= n)
    end = F.max("_prefix") if largest else F.min("_prefix")
    bounds = reached.groupBy(*group).agg(end.alias("_end")).filter(F.col("_end").isNotNull()).collect()
    keep, bounded = F.lit(False), F.lit(False)
    for row in bounds:
        mine = F.lit(True)
        for name in group:
            mine &= F.col(name).eqNullSafe(F.lit(row[name]))
        keep |= mine & (prefix >= row["_end"] if largest else prefix <= row["_end"])
        bounded |= mine
    return df.filter(keep | ~bounded)


def _first(df: DataFrame, order: Sequence[Column], n: int, group: Sequence[str]) -> DataFrame:
    numbered = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    return numbered.filter(F.col("_rank") <= n).drop("_rank")
