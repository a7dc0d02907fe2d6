"""Connected components over an edge table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import written_table


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(low.select("a", F.col("m").alias("b"))).distinct()


def roots(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b) that is not a root; root = smallest node.

    Each round halves distances to the root, so rounds grow with the logarithm of the
    longest chain. A round is written to the shared folder; hot centres are joined by a
    unique minimum per node, so adaptive execution may split them. No edges give no rows.
    """
    oriented = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    current = written_table(oriented, "edges")
    state = _state(current)
    while True:
        current = written_table(_small_star(_large_star(current)), "edges")
        after = _state(current)
        if after == state:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = after
