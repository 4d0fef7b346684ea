"""Connected components by alternating large and small stars.

Each round hangs every node onto the smallest node it knows, until all edges form stars: edges that do from
the beginning need no round. Rounds are written tables, so a lost executor costs one round at most.
Only edges are held, never the graph on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.operators.keyed_join import attach_by_key
from colloquy.staging import delete, held, shuffles_freed, stage


# Bytes of a round's minima that are broadcast: executors hold those of many rounds for a while.
SMALL = 256 * 1024


def connected_components(edges: DataFrame) -> DataFrame:
    """``node``, ``component`` for every node of ``edges`` (columns ``a``, ``b``, of one type):
    the smallest node reachable. Loops and repeated edges are fine; nulls must be gone.

    The minima are combined before they are shuffled. A node with very many neighbours is a key of the
    joins with one row on the other side: that side is broadcast where its size is small, and
    the node's edges are salted where it is not.
    """
    spark = edges.sparkSession
    with shuffles_freed(spark):
        kept = _stars(spark, edges)
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    return nodes.join(kept.select(F.col("a").alias("node"), F.col("b").alias("component")), "node", "left").select(
        "node", F.coalesce("component", "node").alias("component")
    )


def _stars(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """The smallest node (``b``) of each node (``a``) that is not the smallest itself. The tables of a round are deleted
    when the next has been written."""
    with held(spark) as folder:
        current = stage(edges.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "stars")
    while not _are_stars(current):
        with held(spark) as made:
            current = _round(current)
        delete(spark, folder)
        folder = made
    kept = stage(current, "stars")
    delete(spark, folder)
    return kept


def _are_stars(current: DataFrame) -> bool:
    """Whether each node hangs on one other at most, and on one that hangs on none: the larger node of an edge comes
    first, so the others are the smallest of their components, and no round would move an edge."""
    ends = current.select(F.col("a").alias("node"), F.lit(1).alias("hangs"), F.lit(0).alias("holds"))
    ends = ends.union(current.select("b", F.lit(0), F.lit(1)))
    known = ends.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
    return known.filter((F.col("hangs") > 1) | ((F.col("hangs") > 0) & (F.col("holds") > 0))).isEmpty()


def _round(current: DataFrame) -> DataFrame:
    both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = stage(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.count(F.lit(1)).alias("n")), "least")
    large = attach_by_key(both.filter(F.col("b") > F.col("a")), least, "a", "n", spread_by=("b",), broadcast_limit=SMALL)
    large = stage(large.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "stars")
    least = stage(large.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n")), "least")
    small = attach_by_key(large, least, "a", "n", spread_by=("b",), broadcast_limit=SMALL).filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return stage(small.union(least.select("a", F.col("m").alias("b"))).distinct(), "stars")
