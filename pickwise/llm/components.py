"""Connected components of a large edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickwise.llm.common import forget, written


def fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step, written.  Large: link every greater neighbour of a node to the least
    node around it; small: link the node and its lesser neighbours to the least of them."""
    if large:
        around = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        around = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    # the minima are a written table of their own, so both sides of the join are plain
    # shuffles and adaptive execution can split a hub
    least = written(around.groupBy("a").agg(F.min("b").alias("m"))
                    .select("a", F.least("a", "m").alias("m")))
    moved = around.join(least, "a")
    if large:
        moved = moved.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = (moved.select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(least.select("a", F.col("m").alias("b"))))
    out = written(moved.filter("a != b").distinct())
    forget(least)
    return out


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the least node reachable, for every node that has an edge.

    ``edges`` has two long columns a and b.  Runs until nothing moves; the number of
    rounds grows with the logarithm of the table, not with the length of a chain.
    """
    now = written(edges.select("a", "b").filter("a != b").distinct())
    seen = fingerprint(now)
    while True:
        big = star(now, True)
        after = star(big, False)
        forget(now, big)
        now, before = after, seen
        seen = fingerprint(now)
        if seen == before:
            # at rest every edge leads from a node to its root
            roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
