"""Exact top-k by inner product with two cover trees.

Vectors become integers, floor(scale * x). Each row goes to its nearest pivot (of a
bounded sample); the rows of a pivot are dealt to blocks of a bounded size, each of
which becomes a cover tree; so do blocks of the queries. First each query block meets
the few blocks whose centres are most like its own, which gives each query a kth score
to beat. A pair of blocks is looked at only if their roots' largest possible product,
<q, c> + |q| Rc + |c| Rq + Rq Rc, reaches the worst of these scores in the query
block. Inside a pair, pairs of nodes are cut off in the same way; what is left is
scored exactly. The best of all blocks are ranked last.

Defined results: null vectors, and those with null or non-finite components, take no
part; vectors may be of any length, and only those of one length are compared; ties go
to the smaller id; a query never meets rows of its own id; rows that repeat an id count
as rows; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stelae.runtime import ship_package, stored

BLOCK_ROWS, LEAF_ROWS, SHRINK = 4096, 48, 0.75
#: Queries of a block; pivots at most; blocks that give the first scores; query blocks
#: that meet a block of rows in one task.
QUERY_ROWS, PIVOTS, SEEDS, TASK_GROUPS = 512, 256, 2, 8


class CoverTree:
    """Nodes over points sorted so that each node owns a range. All points of a node
    lie within its radius of its centre; the centres of a node's children are further
    apart than the radius allowed to them. Nodes that no longer split are leaves."""

    def __init__(self, points: np.ndarray, ids: np.ndarray):
        n = len(points)
        order = np.empty(n, np.int64)
        self.centre, self.radius, self.range, self.children = [], [], [], []
        filled = 0

        def add(members: np.ndarray, centre: int) -> int:
            nonlocal filled
            far = np.sqrt(((points[members] - points[centre]) ** 2).sum(1))
            radius = float(far.max())
            node = len(self.centre)
            self.centre.append(points[centre])
            self.radius.append(radius * (1 + 1e-12) + 1e-9)
            self.range.append(None)
            self.children.append([])
            begin = filled
            groups = [] if len(members) <= LEAF_ROWS or radius == 0 else split(members, far, radius * SHRINK)
            if len(groups) < 2 or len(groups) * 4 > len(members):
                order[filled : filled + len(members)] = members
                filled += len(members)
            else:
                for some, middle in groups:
                    self.children[node].append(add(some, middle))
            self.range[node] = (begin, filled)
            return node

        def split(members: np.ndarray, far: np.ndarray, allowed: float):
            groups, near, rest = [], far, members
            while len(rest):
                inside = near <= allowed
                if groups or inside.any():
                    middle = rest[np.argmin(near)]
                    if groups:
                        inside[np.argmin(near)] = True
                    groups.append((rest[inside], middle))
                    rest = rest[~inside]
                if len(groups) * 4 > len(members) or not len(rest):
                    break
                near = np.sqrt(((points[rest] - points[rest[0]]) ** 2).sum(1))
            if len(rest):
                return []
            return groups

        if n:
            add(np.arange(n), int(np.argmin(((points - points.mean(0)) ** 2).sum(1))))
        self.points, self.ids = points[order], ids[order]
        self.norm = [float(np.sqrt((c**2).sum())) for c in self.centre]


def search(queries: CoverTree, rows: CoverTree, k: int, known: np.ndarray | None = None):
    """For each query of the tree: the k best (score, id), as arrays; missing ones
    have the score NONE. known: kth scores from elsewhere; rows below may be missing."""
    n = len(queries.ids)
    best = np.full((n, k), NONE, np.int64)
    best_ids = np.full((n, k), np.iinfo(np.int64).max, np.int64)
    if not n or not len(rows.ids):
        return best, best_ids
    pairs = [(0, 0)]
    while pairs:
        q, c = pairs.pop()
        q0, q1 = queries.range[q]
        dot = float(queries.centre[q] @ rows.centre[c])
        rq, rc = queries.radius[q], rows.radius[c]
        most = dot + queries.norm[q] * rc + rows.norm[c] * rq + rq * rc
        worst = best[q0:q1, -1] if known is None else np.maximum(best[q0:q1, -1], known[q0:q1])
        if most + 1e-6 * (1 + abs(most)) < worst.min():
            continue
        inner_q, inner_c = queries.children[q], rows.children[c]
        if not inner_q and not inner_c:
            c0, c1 = rows.range[c]
            scores = np.rint(queries.points[q0:q1] @ rows.points[c0:c1].T).astype(np.int64)
            ids = np.broadcast_to(rows.ids[c0:c1], scores.shape)
            scores = np.where(ids == queries.ids[q0:q1, None], NONE, scores)
            scores = np.concatenate([best[q0:q1], scores], 1)
            ids = np.concatenate([best_ids[q0:q1], ids], 1)
            order = np.lexsort((ids, -scores), axis=1)[:, :k]
            best[q0:q1] = np.take_along_axis(scores, order, 1)
            best_ids[q0:q1] = np.take_along_axis(ids, order, 1)
        elif inner_c and (rc >= rq or not inner_q):
            like = [float(queries.centre[q] @ rows.centre[x]) for x in inner_c]
            pairs += [(q, inner_c[i]) for i in np.argsort(like, kind="stable").tolist()]
        else:
            pairs += [(x, c) for x in inner_q]
    return best, best_ids


NONE = np.iinfo(np.int64).min // 4


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """-> id, v array<long>; rows that take no part are left out."""
    wide = F.transform(vector_col, lambda x: x.cast("double"))
    wrong = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), wide.alias("v")).where("v is not null and id is not null")
    return rows.where(~wrong).select("id", F.transform("v", lambda x: F.floor(x * scale)).alias("v"))


def _with_pivot(rows: DataFrame, pivots: list[np.ndarray]) -> DataFrame:
    """rows (id, v) -> id, v, width, pivot: the nearest one of the row's length, or 0."""
    by_width: dict[int, list[np.ndarray]] = {}
    for p in pivots:
        by_width.setdefault(len(p), []).append(p)
    held = {n: np.stack(p) for n, p in by_width.items()}

    def run(frames):
        for frame in frames:
            width = frame["v"].map(len).to_numpy(np.int64)
            pivot = np.zeros(len(frame), np.int64)
            for n in np.unique(width).tolist():
                if n and n in held:
                    own = np.flatnonzero(width == n)
                    points = np.stack([np.asarray(frame["v"].iloc[i], np.float64) for i in own])
                    far = (held[n] ** 2).sum(1) - 2 * points @ held[n].T
                    pivot[own] = far.argmin(1)
            yield frame.assign(width=width, pivot=pivot)

    return rows.mapInPandas(run, "id long, v array<long>, width long, pivot long")


def _trees(rows: DataFrame, block_rows: int) -> DataFrame:
    """rows (id, v, width, pivot) -> width, block, centre, radius, tree: one row for each
    block of about ``block_rows`` at most, its cover tree pickled."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        import pickle

        from stelae.llm import covertree

        group = group.sort_values("id", kind="stable")
        points = np.stack([np.asarray(v, np.float64) for v in group["v"]])
        tree = covertree.CoverTree(points, group["id"].to_numpy(np.int64))
        tree.points = tree.points.astype(np.int32) if np.abs(points).max(initial=0) < 2**31 else tree.points
        row = {c: [group[c].iloc[0]] for c in ("width", "pivot", "part")}
        return pd.DataFrame({**row, "centre": [tree.centre[0]], "radius": [tree.radius[0]], "tree": [pickle.dumps(tree)]})

    sizes = rows.groupBy("width", "pivot").agg(F.ceil(F.count(F.lit(1)) / block_rows).alias("parts"))
    keyed = rows.join(sizes, ["width", "pivot"]).withColumn("part", F.pmod(F.xxhash64("id"), "parts"))
    keyed = keyed.select("id", "v", "width", "pivot", "part")
    found = keyed.groupBy("width", "pivot", "part").applyInPandas(
        run, "width long, pivot long, part long, centre array<double>, radius double, tree binary"
    )
    block = (F.shiftleft("pivot", 48) + F.col("part")).alias("block")
    return found.select("width", block, "centre", "radius", "tree")


def block_pairs(asks: DataFrame, trees: DataFrame) -> DataFrame:
    """Blocks of queries and of rows of one vector length -> width, asked, block, alike
    (product of the centres), most (the largest product of their members)."""
    q = asks.select("width", F.col("block").alias("asked"), F.col("centre").alias("cq"), F.col("radius").alias("rq"))
    c = trees.select("width", "block", F.col("centre").alias("cc"), F.col("radius").alias("rc"))

    def product(x: str, y: str) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)

    q, c = q.withColumn("nq", F.sqrt(product("cq", "cq"))), c.withColumn("nc", F.sqrt(product("cc", "cc")))
    pairs = q.join(c, "width").withColumn("alike", product("cq", "cc"))
    most = F.col("alike") + F.col("nq") * F.col("rc") + F.col("nc") * F.col("rq") + F.col("rq") * F.col("rc")
    return pairs.select("width", "asked", "block", "alike", (most + 1e-6 * (1 + F.abs(most))).alias("most"))


def worth_searching(pairs: DataFrame, seeds: DataFrame) -> DataFrame:
    """The pairs that may still hold one of the best: pairs (width, asked, block, alike,
    most), seeds (width, asked, floor: the worst kth score of the query block)."""
    order = Window.partitionBy("width", "asked").orderBy(F.desc("alike"), "block")
    rest = pairs.withColumn("turn", F.row_number().over(order)).where(F.col("turn") > SEEDS)
    return rest.join(seeds.select("width", "asked", "floor"), ["width", "asked"]).where("most >= floor").select("width", "asked", "block")


def _unpickled(raw: bytes) -> CoverTree:
    import pickle

    tree = pickle.loads(raw)
    tree.points = tree.points.astype(np.float64)
    return tree


def _first_scores(group: pd.DataFrame, k: int) -> pd.DataFrame:
    """A query block and the blocks that it meets first -> the results, one list each,
    the kth scores and the worst of them."""
    asks = _unpickled(group["asks"].iloc[0])
    scores, ids = [], []
    for raw in group.sort_values("turn")["tree"]:
        known = np.sort(np.concatenate(scores, 1), axis=1)[:, -k] if scores else None
        best, best_ids = search(asks, _unpickled(raw), k, known)
        scores.append(best)
        ids.append(best_ids)
    scores, ids = np.concatenate(scores, 1), np.concatenate(ids, 1)
    order = np.lexsort((ids, -scores), axis=1)[:, :k]
    scores, ids = np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)
    real = scores > NONE
    who = np.broadcast_to(asks.ids[:, None], scores.shape)
    return pd.DataFrame({
        "width": [group["width"].iloc[0]], "asked": [group["asked"].iloc[0]], "floor": [float(scores[:, -1].min())],
        "known": [scores[:, -1]], "query_id": [who[real]], "id": [ids[real]], "score": [scores[real]],
    })


def _later_scores(asked: pd.DataFrame, rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """Some query blocks, with their kth scores, and a block of rows."""
    parts = [(np.empty(0, np.int64),) * 3]
    if len(asked) and len(rows):
        tree = _unpickled(rows["tree"].iloc[0])
        for raw, known in zip(asked["asks"], asked["known"], strict=True):
            asks = _unpickled(raw)
            known = np.asarray(known, np.int64)
            best, ids = search(asks, tree, k, known)
            real = (best > NONE) & (best >= known[:, None])
            who = np.broadcast_to(asks.ids[:, None], best.shape)
            parts.append((who[real], ids[real], best[real]))
    return pd.DataFrame(dict(zip(("query_id", "id", "score"), map(np.concatenate, zip(*parts, strict=True)), strict=True)))


def top_k(
    vectors: DataFrame, is_query: Column, k: int, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256
) -> DataFrame:
    """is_query: a condition on ``id``. -> query_id, rank (from 1), id, score."""
    spark = vectors.sparkSession
    ship_package(spark)
    rows = stored(integer_vectors(vectors, id_col, vector_col, scale), "vectors")
    blocks = -(-rows.count() // BLOCK_ROWS)
    drawn = rows.orderBy(F.xxhash64("id"), "id").limit(min(PIVOTS, blocks)).select("v").collect() if blocks > 1 else []
    rows = stored(_with_pivot(rows, [np.array(r["v"], np.float64) for r in drawn]), "pivots")
    trees = stored(_trees(rows, BLOCK_ROWS), "trees")
    asks = stored(_trees(rows.where(is_query), QUERY_ROWS), "asks")
    pairs = stored(block_pairs(asks, trees), "block_pairs")
    asked = asks.select("width", F.col("block").alias("asked"), F.col("tree").alias("asks"))

    def seed_run(group: pd.DataFrame) -> pd.DataFrame:
        from stelae.llm import covertree

        return covertree._first_scores(group, k)

    def pair_run(some: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        from stelae.llm import covertree

        return covertree._later_scores(some, own, k)

    order = Window.partitionBy("width", "asked").orderBy(F.desc("alike"), "block")
    first = pairs.withColumn("turn", F.row_number().over(order)).where(F.col("turn") <= SEEDS)
    first = first.join(trees.select("width", "block", "tree"), ["width", "block"]).join(asked, ["width", "asked"])
    seeds = first.select("width", "asked", "turn", "asks", "tree").groupBy("width", "asked").applyInPandas(
        seed_run,
        "width long, asked long, floor double, known array<long>, query_id array<long>, id array<long>, score array<long>",
    )
    seeds = stored(seeds, "seeds")
    left = worth_searching(pairs, seeds)
    # Some query blocks at a time meet one block of rows, which is sent once for them.
    groups = max(1, -(-asks.count() // TASK_GROUPS))
    left = stored(left.withColumn("chunk", F.pmod(F.xxhash64("asked"), F.lit(groups))), "left")
    some = left.join(asked, ["width", "asked"]).join(seeds.select("width", "asked", "known"), ["width", "asked"])
    own = left.select("width", "block", "chunk").distinct().join(trees.select("width", "block", "tree"), ["width", "block"])
    key = ["width", "block", "chunk"]
    own = own.select(*[F.col(c).alias(f"own_{c}") for c in key], "tree").groupBy(*[f"own_{c}" for c in key])
    later = some.select(*key, "asks", "known").groupBy(*key).cogroup(own)
    later = later.applyInPandas(pair_run, "query_id long, id long, score long")
    found = seeds.select(F.explode(F.arrays_zip("query_id", "id", "score")).alias("x")).select("x.query_id", "x.id", "x.score")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    ranked = found.unionByName(later).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "id", "score")
