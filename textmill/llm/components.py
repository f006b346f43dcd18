"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.storage import stage_table


def connected(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of ``links`` (a, b).

    Alternating star contraction: a large star hangs a node's larger neighbours on its smallest one, a small star does
    so for the smaller neighbours. Both only need minima, so no neighbourhood is gathered, and the number of rounds
    grows with the logarithm of a component's diameter. Each round is a written table; two numbers tell when it stops.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    edges, seen = stage_table(edges, "links"), None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        seen = state
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("u")).agg(F.least(F.min("b"), F.min("a")).alias("m"))
        large = (
            edges.join(least, F.col("b") == F.col("u")).select("a", F.col("m").alias("b")).filter("a <> b").distinct()
        )
        least = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        small = large.join(least, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        hung = small.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
        edges = stage_table(hung.filter("a <> b").distinct(), "links")
