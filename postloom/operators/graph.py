"""Connected components over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postloom.session import materialize


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(
        F.count("*").alias("n"), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0).cast("long")).alias("x")
    ).first()
    return row["n"], row["x"]


def _minima(edges: DataFrame, key: str, value: str) -> DataFrame:
    """Smallest ``value`` per ``key``, written down so that the join that follows has plain exchanges on both sides:
    adaptive execution may then split a hot key or broadcast the table when its measured size is small."""
    return materialize(edges.groupBy(key).agg(F.min(value).alias("m")), "minima")


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)`` (two columns of one orderable type): root is the smallest
    node that can be reached. Nodes without an edge do not occur; loops and repeated edges are ignored.

    Alternates the large-star and small-star steps, which need a number of rounds about the logarithm of the longest
    chain and never more edges than there are; each round is a written table, so a lost executor costs a round at most.
    """
    current = materialize(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    state = _state(current)
    while True:
        # Large star: every larger neighbour of a node moves to the smallest node around it.
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = _minima(both.select("a", F.least("a", "b").alias("b")), "a", "b")
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = materialize(large.distinct(), "large")
        # Small star: a node and its smaller neighbours move to the smallest of them.
        low = _minima(large, "a", "b")
        small = large.join(low, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        current = materialize(small.unionByName(low.select("a", F.col("m").alias("b"))).distinct(), "edges")
        before, state = state, _state(current)
        if before == state:
            break
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
