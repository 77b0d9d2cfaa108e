"""Connected components of an edge table, by large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recmill.sources.scratch import materialise


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _with_least(edges: DataFrame, key: str, least: str) -> DataFrame:
    """Add the least ``least`` of each ``key``; stored first, so that a hot key's join can be split."""
    other = F.min(least).alias("_m")
    minima = materialise(edges.groupBy(F.col(key).alias("_k")).agg(other), "star")
    return edges.join(minima, F.col(key) == F.col("_k"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    joined = _with_least(both, "a", "b").filter(F.col("b") > F.col("a"))
    return joined.select(F.col("b").alias("a"), F.least("a", "_m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    joined = _with_least(edges, "a", "b")
    kept = joined.select("a", F.col("_m").alias("b"))
    moved = joined.filter(F.col("b") != F.col("_m")).select(F.col("b").alias("a"), F.col("_m").alias("b"))
    return kept.unionByName(moved).distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of an edge; root is the least node of its component.

    Rows with a null end and self-links link nothing. Every round is stored, so a lost
    executor costs one round at most, and nothing but two totals reaches the driver.
    """
    ends = edges.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
    current = materialise(ends.distinct(), "edges")
    before = _state(current)
    while before[0]:
        current = materialise(_small_star(materialise(_large_star(current), "edges")), "edges")
        after = _state(current)
        if after == before:
            break
        before = after
    roots = current.select("b").distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        roots.select(F.col("b").alias("node"), F.col("b").alias("root"))
    )
