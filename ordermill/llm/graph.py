"""Connected components of a graph of any size, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.words import stored


def _smallest(edges: DataFrame) -> DataFrame:
    """For each node the smallest node among its neighbours and itself."""
    return edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def merged(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """The labels of :func:`components` after more edges, from a graph of the components alone."""
    def named(side: str) -> DataFrame:
        return labels.select(F.col("doc_id").alias(side), F.col("label").alias(f"{side}_label"))

    between = (edges.join(named("a"), "a", "left").join(named("b"), "b", "left")
               .select(F.coalesce("a_label", "a").alias("a"),
                       F.coalesce("b_label", "b").alias("b")))
    moved = stored(components(between), "moved")
    new = moved.select(F.col("doc_id").alias("label"), F.col("label").alias("new"))
    return (labels.join(new, "label", "left")
            .select("doc_id", F.coalesce("new", "label").alias("label"))
            .union(moved.join(labels, "doc_id", "left_anti").select("doc_id", "label")))


def components(edges: DataFrame) -> DataFrame:
    """``doc_id, label`` of each node of the edges ``a, b``; the label is its component's smallest.

    A large star links every larger neighbour of a node to the smallest node around it; a small
    star does so for the smaller neighbours and the node itself. Both only ever see, per node, one
    minimum, joined back to its edges, so a hub with many neighbours is split like any skewed join.
    When a round changes nothing, all that is left are stars around each component's smallest node.
    """
    links = (edges.filter("a != b")
             .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    links = stored(links, "graph")
    while True:
        both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            links.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = (both.join(_smallest(both), "u").filter("v > u")
                 .select(F.col("m").alias("a"), F.col("v").alias("b")).filter("a != b").distinct())
        down = large.select(F.col("b").alias("u"), F.col("a").alias("v"))
        lows = _smallest(down)
        small = (down.join(lows, "u").select(F.col("m").alias("a"), F.col("v").alias("b"))
                 .union(lows.select(F.col("m").alias("a"), F.col("u").alias("b")))
                 .filter("a != b").distinct())
        after = stored(small, "graph")
        # Done when nobody has two smaller neighbours and no centre is somebody's neighbour.
        crowded = after.groupBy("b").agg(F.count("*").alias("n")).filter("n > 1")
        inner = after.select("b").join(after.select(F.col("a").alias("b")), "b", "left_semi")
        links = after
        if crowded.select("b").union(inner).isEmpty():
            break
    return links.select(F.col("b").alias("doc_id"), F.col("a").alias("label")).union(
        links.select(F.col("a").alias("doc_id"), F.col("a").alias("label")).distinct())
