"""Connected components of an edge table by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelframe.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (both.join(least, "u").where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("a"), F.col("m").alias("b")).where("a != b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` have a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"),
                                                                         F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b) that is not the
    smallest of its component; components are named by their smallest node.

    Every round is written to the shared folder; the driver sees a row count and
    a checksum per round.  Minima are aggregated before a shuffle and the joins
    may be split, so a node with very many links is no single task's burden.
    """
    e = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct()
    e = stored(e, "cc")
    state = None
    while True:
        now = e.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if tuple(now) == state or not now[0]:
            return e.select(F.col("a").alias("node"), F.col("b").alias("component"))
        state = tuple(now)
        e = stored(_small_star(_large_star(e)), "cc")
