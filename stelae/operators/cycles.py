"""Cycles of a directed graph, and layers of what is free of them.

Strongly connected components by forward and backward reach: nodes without edges in or out
are trimmed first, again and again while that is cheap; of the rest each node learns the
least node that reaches it, and what reaches that node back, within those that learned the
same, is its component. Components leave, and the rest goes on. Every round is a few joins
over the edges that are left; nothing is gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stelae.runtime import stored

TRIMS = 3


def _has(df: DataFrame) -> bool:
    return bool(df.limit(1).count())


def _trimmed(edges: DataFrame) -> DataFrame:
    """Edges (a, b) without those at nodes that nothing enters or nothing leaves."""
    for _ in range(TRIMS):
        edges = edges.join(edges.select(F.col("b").alias("a")).distinct(), "a", "left_semi")
        edges = edges.join(edges.select(F.col("a").alias("b")).distinct(), "b", "left_semi").select("a", "b")
    return stored(edges, "edges")


def _least_reaching(edges: DataFrame) -> DataFrame:
    """-> node, color: the least node from which a path leads to it, its own included."""
    colors = stored(edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("color", F.col("node")), "colors")
    moved = colors
    while _has(moved):
        # Only nodes whose color fell tell their successors.
        told = moved.join(edges, moved["node"] == edges["a"]).groupBy(F.col("b").alias("node")).agg(F.min("color").alias("told"))
        step = stored(colors.join(told, "node", "left").withColumn("fell", F.coalesce(F.col("told") < F.col("color"), F.lit(False))), "colors")
        colors = step.select("node", F.least("color", F.coalesce("told", "color")).alias("color"))
        moved = step.where("fell").select("node", F.col("told").alias("color"))
    return colors


def _reach_back(edges: DataFrame, colors: DataFrame) -> DataFrame:
    """-> node, color of those that reach the node of their color through nodes of it."""
    a, b = colors.toDF("a", "color_a"), colors.toDF("b", "color_b")
    inside = stored(edges.join(a, "a").join(b, "b").where("color_a = color_b").select("a", "b"), "inside")
    found = now = stored(colors.where("node = color"), "back")
    while _has(now):
        more = inside.join(now.select(F.col("node").alias("b"), "color"), "b").select(F.col("a").alias("node"), "color").distinct()
        now = stored(more.join(found.select("node"), "node", "left_anti"), "back")
        found = found.unionByName(now)
    return stored(found, "component")


def components(edges: DataFrame) -> DataFrame:
    """edges (a, b) -> node, component (its least node), for nodes on a cycle; a node with an
    edge to itself is one. Repeated edges and nulls do no harm."""
    edges = edges.select("a", "b").dropna().distinct()
    own = edges.where("a = b").select(F.col("a").alias("node"), F.col("a").alias("component"))
    left, out = stored(edges.where("a <> b"), "edges"), own
    while True:
        left = _trimmed(left)
        if not _has(left):
            break
        found = _reach_back(left, _least_reaching(left))
        sizes = found.groupBy("color").count().where("count > 1").select("color")
        out = out.unionByName(found.join(sizes, "color").select("node", F.col("color").alias("component")))
        gone = found.select("node")
        for end in "ab":
            left = left.join(gone.withColumnRenamed("node", end), end, "left_anti")
        left = stored(left.select("a", "b"), "edges")
    return stored(out.groupBy("node").agg(F.min("component").alias("component")), "components")


def cycle_edges(edges: DataFrame, cycles: DataFrame) -> DataFrame:
    """The edges that lie on a cycle: both ends in one component."""
    a, b = cycles.toDF("a", "component"), cycles.toDF("b", "component_b")
    return edges.select("a", "b").distinct().join(a, "a").join(b, "b").where("component = component_b").select("component", "a", "b")


def layers(edges: DataFrame, cycles: DataFrame | None = None) -> DataFrame:
    """-> node, component, layer: nodes of one cycle count as one; those that nothing
    enters are in layer 0, all others one above the highest that leads to them. Takes as
    many rounds as there are layers."""
    edges = edges.select("a", "b").dropna().distinct()
    nodes = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    named = stored(nodes.join(components(edges) if cycles is None else cycles, "node", "left").withColumn("component", F.coalesce("component", "node")), "named")
    ends = edges.join(named.toDF("a", "x"), "a").join(named.toDF("b", "y"), "b").where("x <> y").select("x", "y").distinct()
    ends = stored(ends, "condensed")
    left, layer = named.select(F.col("component").alias("x")).distinct(), 0
    done = None
    while True:
        free = stored(left.join(ends.select(F.col("y").alias("x")).distinct(), "x", "left_anti").withColumn("layer", F.lit(layer)), "layer")
        done = free if done is None else done.unionByName(free)
        ends = stored(ends.join(free.select("x"), "x", "left_anti"), "condensed")
        left = stored(left.join(free.select("x"), "x", "left_anti"), "left")
        layer += 1
        if not _has(left):
            break
    return named.join(done.select(F.col("x").alias("component"), "layer"), "component").select("node", "component", "layer")
