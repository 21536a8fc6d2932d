"""Property-graph operators over nodes (stable_id, source, role, ...) and edges
(type, from_id, to_id, ...)."""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stelae.runtime import stored


def nodes_of_source(nodes: DataFrame, source: str) -> DataFrame:
    return nodes.where(F.col("source") == source)


def with_all_labels(nodes: DataFrame, wanted: list[str]) -> DataFrame:
    return nodes.where(F.size(F.array_except(F.array(*map(F.lit, wanted)), F.col("labels"))) == 0)


def source_records(nodes: DataFrame, source: str, not_role: str) -> DataFrame:
    """Exact source; a node without a role counts as not of the excluded role."""
    return nodes.where((F.col("source") == source) & (F.col("role").isNull() | (F.col("role") != not_role)))


def with_ends(edges: DataFrame, nodes: DataFrame, columns: tuple[str, ...] = ("source", "role")) -> DataFrame:
    """Edges with ``from_<c>`` and ``to_<c>`` of both ends; null where an end is missing."""
    for side in ("from", "to"):
        end = nodes.select(F.col("stable_id").alias(f"{side}_id"), *[F.col(c).alias(f"{side}_{c}") for c in columns])
        edges = edges.join(end.withColumn(f"{side}_found", F.lit(True)), f"{side}_id", "left")
    return edges


def edges_within(edges: DataFrame, nodes: DataFrame, source: str) -> DataFrame:
    own = nodes.where(F.col("source") == source).select("stable_id")
    kept = edges.join(own.withColumnRenamed("stable_id", "from_id"), "from_id", "left_semi")
    return kept.join(own.withColumnRenamed("stable_id", "to_id"), "to_id", "left_semi")


def edges_across(edges: DataFrame, nodes: DataFrame, sources: tuple[str, str]) -> DataFrame:
    ends = with_ends(edges, nodes)
    return ends.where(
        F.col("from_source").isin(*sources) & F.col("to_source").isin(*sources) & (F.col("from_source") != F.col("to_source"))
    ).select("type", "from_id", "to_id", "from_source", "to_source")


def resolve(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges with ``resolved``: both ends exist."""
    ends = with_ends(edges, nodes, ())
    both = F.coalesce("from_found", F.lit(False)) & F.coalesce("to_found", F.lit(False))
    return ends.withColumn("resolved", both).drop("from_found", "to_found")


def upsert(versions: DataFrame, key: str, ordinal: str, columns: list[str]) -> DataFrame:
    """Later wins, property by property: the last value that isn't null."""
    last = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col(ordinal))).alias(c) for c in columns]
    return versions.groupBy(key).agg(*last)


def unique_edges(edges: DataFrame) -> DataFrame:
    return edges.dropDuplicates(["type", "from_id", "to_id"])


def degrees(nodes: DataFrame, edges: DataFrame, types: list[str] | None = None) -> DataFrame:
    """stable_id, in_degree, out_degree; nodes without edges have zero."""
    kept = edges if types is None else edges.where(F.col("type").isin(*types))
    ends = kept.select(F.explode(F.array(F.struct(F.col("from_id").alias("id"), F.lit(0).alias("came")), F.struct(F.col("to_id").alias("id"), F.lit(1).alias("came")))).alias("e"))
    counted = ends.groupBy(F.col("e.id").alias("stable_id")).agg(
        F.sum("e.came").alias("in_degree"), F.sum(1 - F.col("e.came")).alias("out_degree")
    )
    return nodes.join(counted, "stable_id", "left").select(
        *nodes.columns, *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("in_degree", "out_degree")]
    )


def reach(edges: DataFrame, roots: DataFrame, most_steps: int | None = None) -> DataFrame:
    """stable_id, depth of everything that directed edges reach from the roots (in
    ``most_steps`` at most, if given): frontier joins against what has been visited, cut
    each round; a cycle ends by itself."""
    visited = stored(roots.select("stable_id", F.lit(0).alias("depth")).distinct(), "reach")
    frontier, steps = visited, stored(edges.select("from_id", "to_id").distinct(), "steps")
    for depth in count(1) if most_steps is None else range(1, most_steps + 1):
        fresh = frontier.join(steps, frontier.stable_id == steps.from_id).select(F.col("to_id").alias("stable_id")).distinct()
        fresh = fresh.join(visited, "stable_id", "left_anti").withColumn("depth", F.lit(depth))
        frontier = stored(fresh, "frontier")
        if not frontier.limit(1).count():
            break
        visited = visited.unionByName(frontier)
    return visited


def unreached(nodes: DataFrame, reached: DataFrame) -> DataFrame:
    return nodes.join(reached.select("stable_id"), "stable_id", "left_anti")


def owners(nodes: DataFrame, edges: DataFrame, owning: str) -> DataFrame:
    """How many nodes own each node by one edge type, and whether that is exactly one."""
    held = edges.where(F.col("type") == owning).groupBy(F.col("to_id").alias("stable_id"))
    counted = held.agg(F.countDistinct("from_id").alias("n_owners"))
    out = nodes.join(counted, "stable_id", "left").withColumn("n_owners", F.coalesce("n_owners", F.lit(0)).cast("long"))
    return out.withColumn("one_owner", F.col("n_owners") == 1)


def neighbours(edges: DataFrame, owning: str) -> DataFrame:
    """stable_id, kind, neighbour: the owner, siblings under it, and edge targets."""
    own = edges.where(F.col("type") == owning).select(F.col("to_id").alias("stable_id"), F.col("from_id").alias("owner")).distinct()
    other = own.select("owner", F.col("stable_id").alias("neighbour"))
    siblings = own.join(other, "owner").where(F.col("stable_id") != F.col("neighbour"))
    targets = edges.where(F.col("type") != owning).select(F.col("from_id").alias("stable_id"), F.col("to_id").alias("neighbour"))
    return (
        own.select("stable_id", F.lit("owner").alias("kind"), F.col("owner").alias("neighbour"))
        .unionByName(siblings.select("stable_id", F.lit("sibling").alias("kind"), "neighbour"))
        .unionByName(targets.select("stable_id", F.lit("target").alias("kind"), "neighbour"))
        .distinct()
    )


def neighbour_counts(edges: DataFrame, owning: str) -> DataFrame:
    """stable_id, n: how many nodes ``neighbours`` gives, each once. Siblings under a single
    owner are counted by the owner's children; only nodes of several owners are paired."""
    own = edges.where(F.col("type") == owning).select(F.col("to_id").alias("stable_id"), F.col("from_id").alias("owner"))
    own = stored(own.distinct(), "owned")
    owners_of = own.groupBy("stable_id").agg(F.count(F.lit(1)).alias("n"))
    children = own.groupBy("owner").agg(F.count(F.lit(1)).alias("children"))
    several = owners_of.where("n > 1").select("stable_id")
    one = own.join(several, "stable_id", "left_anti").join(children, "owner").select("stable_id", (F.col("children") - 1).alias("n"))
    other = own.select("owner", F.col("stable_id").alias("neighbour"))
    pairs = own.join(several, "stable_id").join(other, "owner").where(F.col("stable_id") != F.col("neighbour"))
    paired = pairs.groupBy("stable_id").agg(F.countDistinct("neighbour").alias("n"))
    targets = edges.where(F.col("type") != owning).select(F.col("from_id").alias("stable_id"), F.col("to_id").alias("neighbour")).distinct()
    under_one = targets.where(F.col("stable_id") != F.col("neighbour")).join(own, "stable_id").join(other, ["owner", "neighbour"], "left_semi")
    known = own.select("stable_id", F.col("owner").alias("neighbour")).unionByName(under_one.select("stable_id", "neighbour"))
    more = targets.join(known, ["stable_id", "neighbour"], "left_anti").groupBy("stable_id").agg(F.count(F.lit(1)).alias("n"))
    # A node that is owner and sibling at once counts once.
    both = own.join(own.select(F.col("stable_id").alias("owner"), F.col("owner").alias("above")), "owner")
    both = both.join(own.select("stable_id", F.col("owner").alias("above")), ["stable_id", "above"], "left_semi")
    both = both.where(F.col("stable_id") != F.col("owner")).select("stable_id", "owner").distinct()
    both = both.groupBy("stable_id").agg((-F.count(F.lit(1))).alias("n"))
    parts = owners_of.unionByName(one).unionByName(paired).unionByName(more).unionByName(both)
    return parts.groupBy("stable_id").agg(F.sum("n").alias("n")).where("n > 0")


def sibling_ordinal(rows: DataFrame, parent: str, order: list[Column | str]) -> DataFrame:
    """Zero-based place among siblings and their number."""
    own = Window.partitionBy(parent)
    return rows.withColumn("ordinal", F.row_number().over(own.orderBy(*order)) - 1).withColumn(
        "siblings", F.count(F.lit(1)).over(own)
    )


def linear_violations(steps: DataFrame, needs: DataFrame) -> DataFrame:
    """Prerequisites that are numbered after the step that needs them. steps (step,
    number), needs (step, prerequisite)."""
    a = steps.select("step", F.col("number").alias("own"))
    b = steps.select(F.col("step").alias("prerequisite"), F.col("number").alias("needed"))
    return needs.join(a, "step").join(b, "prerequisite").where("needed > own").select("step", "prerequisite", "own", "needed")
