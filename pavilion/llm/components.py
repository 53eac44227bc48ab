"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pavilion.llm.storage import stored


def _hung_below(edges: DataFrame, larger_only: bool) -> DataFrame:
    """One star step: hang neighbours of each node below the smallest of them.

    ``edges`` has ``a`` > ``b``. The large star regards both directions and moves
    neighbours larger than the node; the small star regards smaller neighbours
    and moves them and the node itself. The smallest neighbour is an aggregate
    that tasks combine before the shuffle. It is stored before it is joined, so
    that both sides are shuffled for the join alone and a node with a large part
    of all edges can be split.
    """
    if larger_only:
        ends = F.inline(F.array(_pair("a", "b", "u", "v"), _pair("b", "a", "u", "v")))
        around = edges.select(ends)
        lowest = around.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        moved = around.where("v > u").join(stored(lowest, "lowest"), "u")
        return moved.select(F.col("v").alias("a"), F.col("m").alias("b")).where("a > b")
    lowest = stored(edges.groupBy("a").agg(F.min("b").alias("m")), "lowest")
    moved = edges.join(lowest, "a").select(F.inline(F.array(_pair("b", "m", "a", "b"), _pair("a", "m", "a", "b"))))
    return moved.where("a > b").distinct()


def _pair(first: str, second: str, *names: str):
    return F.struct(F.col(first).alias(names[0]), F.col(second).alias(names[1]))


def _are_stars(edges: DataFrame) -> bool:
    """True if every node hangs below one other, which itself hangs below none."""
    kinds = F.array(
        F.struct(F.col("a").alias("node"), F.lit(1).alias("below"), F.lit(0).alias("above")),
        F.struct(F.col("b").alias("node"), F.lit(0).alias("below"), F.lit(1).alias("above")),
    )
    nodes = edges.select(F.inline(kinds)).groupBy("node").agg(F.sum("below").alias("below"), F.max("above").alias("above"))
    return nodes.where("below + above > 1 AND below > 0").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``component`` for every node of ``edges`` (``a``, ``b``, of one type).

    The component is its smallest node. Loops, repeated and reversed edges are
    allowed; edges with a null end are ignored. Alternating star steps shorten
    all paths to stars; each step works on edges alone, stays as large as the
    graph and is stored, and their number grows with the logarithm of the longest
    path. Whether a step is left to do is all that the driver learns.
    """
    tidy = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = stored(tidy.where("a > b").distinct(), "edges")
    while not _are_stars(edges):
        edges = stored(_hung_below(_hung_below(edges, True), False), "edges")
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.union(edges.select("b", "b").distinct())
