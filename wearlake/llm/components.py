"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearlake.llm.common import kept


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the least of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # Written, so that Spark can split the rows of a busy node in the join.
    least = kept(both.groupBy("a").agg(F.min("b").alias("least")))
    tied = both.where("b > a").join(least, "a")
    return tied.select(F.col("b").alias("a"), F.least("a", "least").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the least of them."""
    least = kept(edges.groupBy("a").agg(F.min("b").alias("least")))
    own = least.select("a", F.col("least").alias("b"))
    others = edges.join(least, "a").where("b <> least")
    return own.unionByName(others.select(F.col("b").alias("a"), F.col("least").alias("b")))


def _state(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.col("b").cast("decimal(38,0)"))).first()
    )


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, the least node it reaches, for every node with an edge.

    ``edges`` has two long columns ``a`` and ``b``. Loops, repeated and turned edges and
    edges with a null end are allowed; the last count for nothing. Rows of a busy node
    are combined before the shuffle and its join is split by Spark where it is skewed.
    Each round is written to the shared folder.
    """
    clean = edges.where("a <> b").select(F.col("a").cast("long"), F.col("b").cast("long"))
    current = kept(clean.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = _state(current)
    while True:
        # Edges point down: the first end is the larger one after either step.
        current = kept(_small_star(kept(_large_star(current).distinct())).distinct())
        after = _state(current)
        if after == before:
            break
        before = after
    stars = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(stars.select("component", "component").toDF("node", "component").distinct())
