"""Lloyd's clustering over integer vectors by filtering kd-trees.

Vectors become integers, floor(scale * x), and are written once in the order of
kd-trees: each task cuts blocks of its rows at the median of the widest axis, again and
again, down to leaves. A round reads them in that order; leaves have counts, integer
sums and boxes, and a block's nodes get theirs from their children. From the root down
a node keeps the centroids that may be nearest to some point of its box: a centroid goes
where the one nearest to the box's middle is strictly nearer to every point of the box.
A node with one centroid left is assigned whole, by count and sum; leaves with several
are resolved point by point. Tasks hand on sums for each centroid only, which Spark adds
up; everything is exact in integers, so neither the order of rows nor the cut into
blocks changes a result.

Defined results: vectors that are null, of another length, or with null or non-finite
components take no part, nor do those with a component of ``LARGEST`` or more once
scaled (squared distances might not fit a long); fewer vectors than centroids give as
many centroids as there are; rows that repeat an id or a vector are vectors of their
own, and of start rows with one id the smaller vector comes first; null ids are hashed
like an empty text; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stelae.runtime import ship_package, stored

#: Rows of a block at least, and less than twice as many; halved DEPTH times they fit leaves.
BLOCK_ROWS, LEAF_ROWS, DEPTH, LARGEST = 8192, 32, 9, 1 << 26


def scaled_vectors(vectors: DataFrame, id_col: str, vector_col: str, scale: int, largest: int = LARGEST) -> DataFrame:
    """-> id, v array<long>; vectors that take no part are left out."""
    wide = vectors.select(F.col(id_col).cast("long").alias("id"), F.transform(vector_col, lambda x: x.cast("double")).alias("v"))
    right = F.forall("v", lambda x: F.coalesce(F.abs(x) < largest / scale, F.lit(False)))
    return wide.where(F.col("v").isNotNull() & right).select("id", F.transform("v", lambda x: F.floor(x * scale)).alias("v"))


def as_matrix(column: pa.Array) -> np.ndarray:
    """Lists of one length -> a matrix of integers."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def as_lists(points: np.ndarray) -> pa.Array:
    offsets = np.arange(len(points) + 1, dtype=np.int32) * points.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(points, np.int64).reshape(-1)))


def kd_order(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """-> the order of the points in a kd-tree, and for each place the leaf's number: the
    way to it from the root, a bit for each of DEPTH cuts, the first one the highest."""
    order, leaf, stack = np.arange(len(points)), np.empty(len(points), np.int64), [(0, len(points), 0, DEPTH)]
    while stack:
        i, j, way, left = stack.pop()
        own = order[i:j]
        spread = points[own].max(0) - points[own].min(0)
        if j - i <= LEAF_ROWS or not spread.any() or not left:
            leaf[i:j] = way << left
            continue
        axis, middle = int(spread.argmax()), (j - i) // 2
        order[i:j] = own[np.argpartition(points[own, axis], middle)]
        stack += [(i + middle, j, 2 * way + 1, left - 1), (i, i + middle, 2 * way, left - 1)]
    return order, leaf


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray]]:
    ids, points, held = [], [], 0
    for batch in batches:
        for i in range(0, len(batch), BLOCK_ROWS):
            part = batch.slice(i, BLOCK_ROWS)
            ids.append(part.column("id"))
            points.append(as_matrix(part.column("v")))
            held += len(part)
            if held >= BLOCK_ROWS:
                yield pa.concat_arrays(ids), np.concatenate(points)
                ids, points, held = [], [], 0
    if held:
        yield pa.concat_arrays(ids), np.concatenate(points)


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, v -> the same rows, block by block in kd order, with the number of their leaf."""
    for block, (ids, points) in enumerate(_blocks(batches)):
        order, leaf = kd_order(points)
        leaf += block << DEPTH
        yield pa.RecordBatch.from_pydict({"id": ids.take(pa.array(order)), "leaf": pa.array(leaf), "v": as_lists(points[order])})


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b for integers, exactly: by floats while every sum stays within 53 bits."""
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[-1]
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    return a @ b


def _changes(numbers: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.r_[True, numbers[1:] != numbers[:-1]])


class Nodes:
    """The trees over consecutive rows, level by level from the leaves to the blocks'
    roots: boxes, counts, sums, sums of squares, first and last place; for each level
    above the leaves, the first child of each node. Nodes cut by the end of the rows at
    hand stand for the rest of them."""

    def __init__(self, points: np.ndarray, leaf: np.ndarray):
        first = _changes(leaf)
        number, last = leaf[first], np.r_[first[1:], len(points)]
        square = np.add.reduceat((points**2).sum(1), first)
        self.levels = [(np.minimum.reduceat(points, first), np.maximum.reduceat(points, first), last - first, np.add.reduceat(points, first), square, first, last)]
        self.children = []
        merge = (np.minimum, np.maximum, np.add, np.add, np.add, np.minimum, np.maximum)
        for _ in range(DEPTH):
            number = number >> 1
            begin = _changes(number)
            number = number[begin]
            self.children.append(begin)
            self.levels.append(tuple(f.reduceat(x, begin) for f, x in zip(merge, self.levels[-1], strict=True)))


def _open_centroids(low: np.ndarray, high: np.ndarray, may: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """may: which centroids each box still has -> which it keeps."""
    square = (centroids**2).sum(1)
    middle = square - product(low + high, centroids.T)  # differs by a constant of the box
    best = np.where(may, middle, np.iinfo(np.int64).max).argmin(1)
    out = may.copy()
    for z in np.unique(best).tolist():
        own = np.flatnonzero(best == z)
        w = centroids - centroids[z]
        # Least of |c - p|^2 - |z - p|^2 over the points p of the box.
        lead = square - square[z] - product((low + high)[own], w.T) - product((high - low)[own], np.abs(w).T)
        out[own] &= lead <= 0
    return out


def filter_nodes(points: np.ndarray, leaf: np.ndarray, centroids: np.ndarray):
    """Yields what is assigned: (cluster, first and last place, count, sum, sum of squares)
    of a whole node, or (None, first and last place, open centroids) of a leaf."""
    tree = Nodes(points, leaf)
    nodes = np.arange(len(tree.levels[-1][0]))
    may = np.ones((len(nodes), len(centroids)), bool)
    for level in range(DEPTH, -1, -1):
        low, high, count, total, square, first, last = (x[nodes] for x in tree.levels[level])
        may = _open_centroids(low, high, may, centroids)
        whole = may.sum(1) == 1
        for i in np.flatnonzero(whole).tolist():
            yield int(may[i].argmax()), int(first[i]), int(last[i]), int(count[i]), total[i], int(square[i])
        nodes, may = nodes[~whole], may[~whole]
        if level:
            begin = np.r_[tree.children[level - 1], len(tree.levels[level - 1][0])]
            n = begin[nodes + 1] - begin[nodes]
            may = np.repeat(may, n, 0)
            nodes = np.concatenate([np.arange(i, j) for i, j in zip(begin[nodes], begin[nodes + 1], strict=True)] or [nodes])
    for i, node in enumerate(nodes.tolist()):
        yield None, int(tree.levels[0][5][node]), int(tree.levels[0][6][node]), may[i], None, None


def assign(points: np.ndarray, leaf: np.ndarray, centroids: np.ndarray):
    """-> cluster of every point; and for each cluster count, sum and inertia."""
    k, width = centroids.shape
    cluster = np.empty(len(points), np.int64)
    count, total, inertia = np.zeros(k, np.int64), np.zeros((k, width), np.int64), np.zeros(k, np.int64)
    square, left = (centroids**2).sum(1), []
    for c, i, j, n, s, q in filter_nodes(points, leaf, centroids):
        if c is None:
            left.append((i, j, n))
        else:
            cluster[i:j] = c
            count[c] += n
            total[c] += s
            inertia[c] += q - 2 * int((s * centroids[c]).sum()) + n * int(square[c])
    if left:
        at = np.concatenate([np.arange(i, j) for i, j, _ in left])
        may = np.repeat(np.stack([m for *_, m in left]), [j - i for i, j, _ in left], axis=0)
        own = points[at]
        far = np.where(may, square - 2 * product(own, centroids.T), np.iinfo(np.int64).max)
        best = far.argmin(1)
        cluster[at] = best
        np.add.at(count, best, 1)
        np.add.at(total, best, own)
        np.add.at(inertia, best, far[np.arange(len(at)), best] + (own**2).sum(1))
    return cluster, count, total, inertia


def _totals(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """For each centroid: count, inertia and sums of the rows assigned to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from stelae.llm import kdfilter

        found = np.zeros((len(centroids), 2 + centroids.shape[1]), np.int64)
        for batch in batches:
            if len(batch):
                points = kdfilter.as_matrix(batch.column("v"))
                _, count, total, inertia = kdfilter.assign(points, batch.column("leaf").to_numpy(), centroids)
                found += np.column_stack([count, inertia, total])
        yield pa.RecordBatch.from_pydict({"found": kdfilter.as_lists(found.reshape(1, -1))})

    parts = rows.select("leaf", "v").mapInArrow(run, "found array<long>")
    sums = parts.select(F.posexplode("found").alias("place", "x")).groupBy("place").agg(F.sum("x").alias("x")).collect()
    out = np.zeros(len(centroids) * (2 + centroids.shape[1]), np.int64)
    for r in sums:
        out[r["place"]] = r["x"]
    return out.reshape(len(centroids), -1)


def cluster(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", width: int = 64, scale: int = 64, centroids: int = 16, rounds: int = 3
) -> DataFrame:
    """-> id, cluster, distance (squared), cluster_inertia, inertia, centroid."""
    spark = vectors.sparkSession
    ship_package(spark)
    kept = scaled_vectors(vectors.where(F.size(vector_col) == width), id_col, vector_col, scale)
    rows = stored(kept.mapInArrow(_in_order, "id long, leaf long, v array<long>"), "kd_rows")
    drawn = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    start = rows.orderBy(drawn, "id", "v").limit(centroids).select("v").collect()
    now = np.array([r["v"] for r in start], np.int64).reshape(-1, width)
    out = "id long, cluster int, distance long, cluster_inertia long, inertia long, centroid array<long>"
    if not len(now):
        return spark.createDataFrame([], out)
    for _ in range(rounds):
        found = _totals(rows, now)
        some = found[:, 0] > 0
        now = now.copy()
        now[some] = found[some, 2:] // found[some, :1]
    inertia = _totals(rows, now)[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from stelae.llm import kdfilter

        for batch in batches:
            if len(batch):
                points = kdfilter.as_matrix(batch.column("v"))
                own, *_ = kdfilter.assign(points, batch.column("leaf").to_numpy(), now)
                far = ((points - now[own]) ** 2).sum(1)
                yield pa.RecordBatch.from_pydict({
                    "id": batch.column("id"), "cluster": pa.array(own.astype(np.int32)), "distance": pa.array(far),
                    "cluster_inertia": pa.array(inertia[own]), "inertia": pa.array(np.full(len(own), inertia.sum())),
                    "centroid": kdfilter.as_lists(now[own]),
                })

    return rows.mapInArrow(run, out)
