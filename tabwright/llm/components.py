"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.sources.scratch import written


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang neighbours on the least one: larger neighbours (large star) or smaller ones (small star).

    The least neighbour is a min aggregate that combines before the shuffle, and the join back is one
    that can be split, so a node with very many links does not meet in one task.
    """
    links = _both_ways(edges) if large else edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    least = links.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    kept = links.where("v > u") if large else links
    hung = kept.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    if not large:
        hung = hung.unionAll(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return hung.where("a > b").distinct()


def _settled(edges: DataFrame) -> bool:
    """Every node hangs on one node at most and no node with a parent has children: the trees are stars."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionAll(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.where("up > 1 OR (up = 1 AND down = 1)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node with a link; the component is its smallest node.

    ``edges``: columns a, b (long, not null); loops and repeated edges are ignored. Every round's
    edges are written to the shared folder, so a lost executor costs one round at most. The rounds,
    about log(nodes) of them, end when the edges are stars, which one pass over them tells; a star's
    middle is smaller than its leaves, since every edge leads from the larger node to the smaller.
    """
    now = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
    now = written(now, "edges")
    while not _settled(now):
        now = written(_star(_star(now, large=True), large=False), "edges")
    roots = now.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(roots)
