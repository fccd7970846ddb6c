"""Connected components of a stored edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage


def components(edges: DataFrame, rounds: int = 64) -> DataFrame:
    """(id, component) for every id of the edges (a, b); the component is its smallest id.

    Alternating large-star and small-star steps (Kiveris and others, 2014): every step links ids to
    the smallest id around them, so a component becomes a star in a number of steps that grows with
    the logarithm of its size.  Steps are stored, so a lost executor costs one step.
    """
    pairs = stage(_ordered(edges.select("a", "b")), "edges")
    before = None
    for _ in range(rounds):
        # Both directions of each edge, so that every id sees its neighbours.
        both = pairs.select("a", "b").union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stage(both.groupBy("a").agg(F.least("a", F.min("b")).alias("m")), "least")
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stage(_ordered(large), "large-star")
        # From here on each edge goes from the larger id (a) to the smaller (b).
        smallest = stage(large.groupBy("a").agg(F.min("b").alias("m")), "smallest")
        small = large.join(smallest, "a").select("b", "m").withColumnRenamed("b", "a").withColumnRenamed("m", "b")
        pairs = stage(_ordered(small.union(smallest.select("a", F.col("m").alias("b")))), "small-star")
        state = pairs.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")
        ).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = pairs.select("b").distinct()
    return pairs.select(F.col("a").alias("id"), F.col("b").alias("component")).union(
        roots.select("b", F.col("b").alias("component"))
    )


def _ordered(pairs: DataFrame) -> DataFrame:
    """Distinct edges from the larger to the smaller id."""
    return (
        pairs.filter("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
