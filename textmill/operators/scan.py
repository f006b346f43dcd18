"""Running values over the pieces of one long thing, combined in a tree.

A value before a piece is combined from what came before in its block of pieces and from all earlier blocks. So a thing of
``n`` pieces needs tasks of ``BLOCK`` rows and one of ``n / BLOCK``, and rows hold a few numbers, never the pieces.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 1_024


def _before(rows: DataFrame, keys: Sequence[str], order: str, latest: Sequence[str], sums: Sequence[str]) -> list[Column]:
    earlier = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return [
        *(F.last(c, ignorenulls=True).over(earlier).alias(f"{c}_before") for c in latest),
        *(F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in sums),
    ]


def running_before(
    rows: DataFrame, keys: Sequence[str], order: str, latest: Sequence[str] = (), sums: Sequence[str] = (), block: int = BLOCK
) -> DataFrame:
    """Add, per key and in the order of the whole numbers ``order``, what holds before each row: ``<column>_before`` is
    the last known value of a ``latest`` column, null if there is none, and the total of a column of ``sums``.
    """
    columns = [*latest, *sums]
    rows = rows.withColumn("_block", F.floor(F.col(order) / block))
    inside = rows.select("*", *_before(rows, [*keys, "_block"], order, latest, sums))
    totals = rows.groupBy(*keys, "_block").agg(
        *(F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in latest), *(F.sum(c).alias(c) for c in sums)
    )
    carried = totals.select(*keys, "_block", *_before(totals, keys, "_block", latest, sums))
    carried = carried.withColumnsRenamed({f"{c}_before": f"_{c}_carried" for c in columns})
    return inside.join(carried, [*keys, "_block"]).select(
        *(c for c in rows.columns if c != "_block"),
        *(F.coalesce(f"{c}_before", f"_{c}_carried").alias(f"{c}_before") for c in latest),
        *((F.col(f"{c}_before") + F.col(f"_{c}_carried")).alias(f"{c}_before") for c in sums),
    )
