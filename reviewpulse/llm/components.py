"""Connected components of an edge table, without collecting links or groups anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import settle

# Alternating rounds needed grow with the logarithm of the graph; beyond this something is wrong.
MOST_ROUNDS = 60


def connected(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``; the root is the smallest node of its component.

    Alternating large-star and small-star rounds (Kiveris et al. 2014) as joins with one minimum per
    node: a node with many neighbours costs rows, not one task's memory, and adaptive execution splits
    its join. Each round is a table in the shared folder. Loops are ignored; so are null ends.
    """
    current = settle(edges.filter(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = None
    for _ in range(MOST_ROUNDS):
        now = current.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("sign")).first()
        if not now["n"] or (now["n"], now["sign"]) == state:
            break
        state = (now["n"], now["sign"])
        both = current.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(
            current.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, F.col("u") == F.col("w")).select(
            F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "w")
        small = large.join(lowest, F.col("a") == F.col("w"))
        current = settle(
            small.filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionAll(lowest.select(F.col("w").alias("a"), F.col("m").alias("b"))).distinct(), "edges")
    else:
        raise RuntimeError("the components did not settle")
    roots = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionAll(current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
