"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clickweave.workspace import stored


def _distinct(edges: DataFrame) -> DataFrame:
    return edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest of its neighbourhood."""
    both = stored(edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))), "both-ways")
    least = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
    return _distinct(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    least = stored(edges.groupBy("u").agg(F.min("v").alias("m")), "least")
    tied = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _distinct(tied.union(least.select("u", F.col("m").alias("v"))))


def _all_stars(edges: DataFrame) -> bool:
    """Whether every node is either the centre of its edges or has one edge to a centre."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("v", F.lit(0), F.lit(1))
    )
    sums = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return sums.where((F.col("up") > 1) | ((F.col("up") == 1) & (F.col("down") == 1))).isEmpty()


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, root): every node of an edge with the smallest node of its component.

    The edges of a round are written and read again; the driver only learns whether all are stars. Sums are combined
    before the shuffle and joins are between stored tables, so a node may have any share of the edges.
    """
    now = stored(_distinct(edges.select(F.col(u).alias("u"), F.col(v).alias("v"))), "edges")
    while not _all_stars(now):
        now = stored(_small_star(stored(_large_star(now), "large-star")), "small-star")
    roots = now.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
