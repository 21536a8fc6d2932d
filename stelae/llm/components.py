"""Connected components by alternating stars, without collecting links.

Links are first reduced where they lie: each stretch of at most LINKS_AT_ONCE of them
becomes the stars of its own components, which shortens paths and drops links that
close a circle. Links that are few enough for one stretch are then done, others go on
in rounds over all of them, until they are few enough or don't change.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from stelae.runtime import discard, ship_package, stored

#: Links that a task holds at once: two longs each.
LINKS_AT_ONCE = 1 << 18


def stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of some links, ascending, and the least node of each one's component.
    In each turn at least half of the trees that aren't whole components yet hang
    themselves on a tree with a lesser root."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    root = np.arange(len(nodes))
    while True:
        ra, rb = root[a], root[b]
        apart = ra != rb
        if not apart.any():
            return nodes, nodes[root]
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while not np.array_equal(up := root[root], root):
            root = up


def _reduced(edges: DataFrame, n: int, roots: bool) -> DataFrame:
    """edges (u, v), n of them -> u, v: the stars of their stretches, with a link of each
    root to itself, if ``roots``."""
    ship_package(edges.sparkSession)
    most = LINKS_AT_ONCE

    def run(batches):
        from stelae.llm import components

        def found(held):
            u, v = (np.concatenate([b.column(i).to_numpy() for b in held]) for i in (0, 1))
            node, root = components.stars(u, v)
            keep = slice(None) if roots else node != root
            return pa.RecordBatch.from_arrays([pa.array(node[keep]), pa.array(root[keep])], names=["u", "v"])

        held, rows = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, most):
                part = batch.slice(at, most)
                if rows + part.num_rows > most:
                    yield found(held)
                    held, rows = [], 0
                held.append(part)
                rows += part.num_rows
        if held:
            yield found(held)

    return edges.coalesce(max(1, -(-n // most))).mapInArrow(run, "u long, v long")


def _written(edges: DataFrame) -> tuple[DataFrame, dict]:
    """The stored links, and their number and digests, of what is written, so that it
    needn't be read for that."""
    seen = Observation()
    marks = F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("digest"), F.sum(F.col("v") % 1000003).alias("sum")
    edges = stored(edges.observe(seen, *marks), "edges")
    return edges, seen.get


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """links (a, b: longs) -> node, root: the least node of its component, as a stored
    table. Each round points neighbours at least neighbours (large star, then small
    star); rounds grow with the logarithm of the longest path. Self links and repeated
    links do no harm."""
    edges = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    edges, state = _written(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    if state["n"] > LINKS_AT_ONCE:
        before = edges
        edges, state = _written(_reduced(edges, state["n"], False))
        discard(before)
    seen = None
    while state["n"] > LINKS_AT_ONCE and state != seen:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        before, seen = edges, state
        edges, state = _written(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        discard(before)
    if state["n"] > LINKS_AT_ONCE:
        leaves = edges.groupBy("u").agg(F.min("v").alias("v"))
        found = leaves.unionByName(edges.select("v").distinct().select(F.col("v").alias("u"), "v"))
    else:
        found = _reduced(edges, state["n"], True)
    out = stored(found.toDF("node", "root"), "roots")
    discard(edges)
    return out
