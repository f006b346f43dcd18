"""Column helpers that several operators of this package share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmill.storage import stage_table

BLANKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Runs of anything but ASCII white space; null gives an empty array."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANKS), lambda w: w != "")


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """The named input columns under internal names, so that no other column of the input can clash."""
    return df.select(*(F.col(f"`{source}`").alias(name) for name, source in columns.items()))


def salted(big: DataFrame, small: DataFrame, keys: list[str], salts: int, spread: Column) -> DataFrame:
    """Inner join of ``big`` with a ``small`` that has one row per key, which may be hot in ``big``.

    Rows of a key are dealt to ``salts`` tasks by ``spread``; ``small`` is repeated that often. Keys compare null-safe.
    """
    small = small.select(*(F.col(k).alias(f"_s_{k}") for k in keys), *(c for c in small.columns if c not in keys))
    small = small.withColumn("_s_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    big = big.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    on = [F.col(k).eqNullSafe(F.col(f"_s_{k}")) for k in keys] + [F.col("_salt") == F.col("_s_salt")]
    return big.join(small, on).drop("_salt", "_s_salt", *(f"_s_{k}" for k in keys))


def places(df: DataFrame, group: str, order: list[str], out: str = "position") -> DataFrame:
    """Add each row's 1-based place among the rows of its group, by a total order.

    Rows are range-partitioned by group and order, so a group of any size is spread. A row's place is its place in its
    partition plus the group's rows in earlier partitions, from a table of counts per partition and group that is
    joined by shuffle. A null group is a group.
    """
    keys = [group, *order]
    placed = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id())
    placed = stage_table(placed, "placed").withColumn("_part", F.shiftright("_at", 33))
    counts = placed.groupBy("_part", group).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        F.col("_part").alias("_p"), F.col(group).alias("_g"), "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    on = (F.col("_part") == F.col("_p")) & F.col(group).eqNullSafe(F.col("_g"))
    return placed.join(starts, on).select(*df.columns, (F.col("_at") - F.col("_first") + F.col("_before") + 1).alias(out))
