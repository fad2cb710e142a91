"""Connected components of links in a table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.session import written


def _smallest(edges: DataFrame) -> DataFrame:
    """Every node's smallest neighbour, or itself: one row per node, combined before the shuffle."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    hung = both.filter(F.col("b") > F.col("a")).join(_smallest(edges), F.col("a") == F.col("node"))
    return hung.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` point from the larger to the smaller node."""
    least = edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), "m")
    hung = edges.join(least, F.col("a") == F.col("node")).filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hung.unionByName(least.select(F.col("node").alias("a"), F.col("m").alias("b"))).distinct()


def _mark(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], int(row[1] or 0)


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, component)`` for every node in ``links``; the component is its smallest node.

    NULL ends are no links, a link to itself makes a component of one. Each round is written to
    the shared folder; only a count and a checksum reach the driver. Stars of any size are
    contracted by aggregation and joins, no node's links are gathered.
    """
    ends = links.select(F.col(a).alias("a"), F.col(b).alias("b")).filter(F.col("a").isNotNull() & F.col("b").isNotNull())
    edges = written(ends.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    alone = edges.filter(F.col("a") == F.col("b")).select(F.col("a").alias("node"))
    edges = edges.filter(F.col("a") != F.col("b"))
    seen = _mark(edges)
    while seen[0]:
        edges = written(_small_star(_large_star(edges)), "stars")
        now = _mark(edges)
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("b").alias("node")).unionByName(alone).distinct()
    leaves = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    own = roots.join(leaves.select("node"), "node", "left_anti").select("node", F.col("node").alias("component"))
    return leaves.unionByName(own)
