"""Whitening by the leading eigenvectors of the covariance, found by LOBPCG.

Vectors become integers, floor(scale * x) + shift. The sums of every dimension are exact;
rows are centred as integers (n times the row less the sums) before anything is
multiplied, so no digits are lost to the mean. Only products of the covariance with a
block of directions are ever asked for: each task multiplies its centred rows with the
block and with themselves, Spark adds the tasks' small matrices up. The driver holds such
blocks (dimensions times a few times the components), never rows.

An iteration takes the iterate, its residuals and the previous directions as a basis, and
the best directions within it (Rayleigh-Ritz). It ends when every wanted residual,
measured by a fresh product, is below ``TOLERANCE`` of the largest eigenvalue; GUARD more
directions are kept so that a tie at the last component doesn't slow it down.

Defined results: vectors that are null, or with null or non-finite components, take no
part, nor do those with a component of 2^40 or more once scaled; vectors of different
lengths are whitened apart, each length with its own n, sums and components; directions
without variance (below 1e-12 of the largest) can't be whitened and give no rows, so a
single vector, or copies of one, gives none; rows that repeat an id or a vector count
each; an empty table gives no rows; further columns are ignored. ``deviation`` is null
where it doesn't fit a long, ``deviation_text`` has it as a decimal number always.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stelae.llm import kdfilter
from stelae.runtime import ship_package, stored

TOLERANCE, GUARD, MOST_ITERATIONS, LEAST_VARIANCE, LARGEST = 1e-13, 8, 500, 1e-12, 1 << 40
OUT = (
    "id long, component int, n long, deviation long, whitened double, explained double, identity_error double, deviation_text string"
)


class Centre:
    """n and the exact sums of each dimension; rows less their mean."""

    def __init__(self, n: int, sums: list[int]):
        self.n = n
        self.whole = np.array([s // n for s in sums], np.int64)
        self.rest = [s % n for s in sums]
        self.part = np.array([r / n for r in self.rest])

    def centred(self, points: np.ndarray) -> np.ndarray:
        return (points - self.whole).astype(np.float64) - self.part

    def deviations(self, points: np.ndarray) -> list[int]:
        """Sum over the dimensions of (n * x - sum)^2, exactly."""
        less = points - self.whole
        if int(np.abs(less).max(initial=0)) ** 2 * less.shape[1] >= 1 << 62:
            less = less.astype(object)
        square, rest = (less**2).sum(1), np.array(self.rest, object)
        fixed = sum(r * r for r in self.rest)
        crossed = (less.astype(object) * rest).sum(1) if max(self.rest) * int(np.abs(less).max(initial=0)) * len(rest) >= 1 << 62 else less @ rest.astype(np.int64)
        return [self.n * self.n * int(a) - 2 * self.n * int(b) + fixed for a, b in zip(square, crossed, strict=True)]


def _added(rows: DataFrame, per_batch, shape: tuple[int, int]) -> np.ndarray:
    """The sum over all rows of what per_batch makes of a matrix of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from stelae.llm import kdfilter

        found = np.zeros(shape)
        for batch in batches:
            if len(batch):
                found += per_batch(kdfilter.as_matrix(batch.column("v")))
        yield pa.RecordBatch.from_pydict({"found": pa.array([found.reshape(-1)], pa.list_(pa.float64()))})

    parts = rows.select("v").mapInArrow(run, "found array<double>")
    out = np.zeros(shape[0] * shape[1])
    for r in parts.select(F.posexplode("found").alias("place", "x")).groupBy("place").agg(F.sum("x").alias("x")).collect():
        out[r["place"]] = r["x"]
    return out.reshape(shape)


def covariance_product(rows: DataFrame, centre: Centre, block: np.ndarray) -> np.ndarray:
    """The covariance of rows (v) times a block of columns."""

    def per_batch(points: np.ndarray) -> np.ndarray:
        c = centre.centred(points)
        return c.T @ (c @ block)

    return _added(rows, per_batch, block.shape) / centre.n


def _basis(*blocks: np.ndarray) -> np.ndarray:
    """Orthonormal columns that span the blocks, earlier ones first; what adds nothing goes."""
    out = np.empty((len(blocks[0]), 0))
    for block in blocks:
        norm = np.sqrt((block**2).sum(0))
        block = block[:, norm > 0] / norm[norm > 0]
        for _ in range(2):  # twice, for full precision
            block = block - out @ (out.T @ block)
            if not block.shape[1]:
                break
            u, s, _ = np.linalg.svd(block, full_matrices=False)
            block = u[:, s > 1e-10 * max(s[0], 1e-300)] if s[0] > 1e-10 else block[:, :0]
        out = np.concatenate([out, block], 1)[:, : len(out)]
    return out


def leading_eigenvectors(product, dimensions: int, components: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray, float]:
    """product: a block -> the symmetric matrix times it. -> falling eigenvalues, their
    vectors as columns, and the largest residual in parts of the first eigenvalue."""
    m = min(dimensions, components + GUARD)
    x = _basis(np.random.default_rng(seed).standard_normal((dimensions, m)))
    vx, fresh = product(x), True
    before, best, idle = np.empty((dimensions, 0)), np.inf, 0
    for _ in range(MOST_ITERATIONS):
        values, turn = np.linalg.eigh((x.T @ vx + vx.T @ x) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        x, vx = x @ turn, vx @ turn
        residual = vx - x * values
        size = np.sqrt((residual**2).sum(0))[:components].max() / max(abs(values[0]), 1e-300)
        idle = 0 if size < best / 2 else idle + 1
        best = min(best, size)
        # At the last digits of the sums the residual no longer falls.
        if size <= TOLERANCE or (idle >= 3 and size <= 100 * TOLERANCE) or not values[0] > 0:
            if fresh:
                return values[:components], x[:, :components], float(size)
            vx, fresh = product(x), True
            continue
        new = _basis(x, residual, before)[:, m:]
        if not new.shape[1]:  # the iterate spans all that can be reached
            vx, fresh, idle = product(x), True, idle + 1
            continue
        space, v_space = np.concatenate([x, new], 1), np.concatenate([vx, product(new)], 1)
        _, turn = np.linalg.eigh((space.T @ v_space + v_space.T @ space) / 2)
        turn = turn[:, ::-1][:, :m]
        before = new @ turn[m:]
        x, vx, fresh = space @ turn, v_space @ turn, False
    raise ArithmeticError(f"residuals of {best} after {MOST_ITERATIONS} iterations")


def _whiten_length(rows: DataFrame, dimensions: int, components: int) -> DataFrame | None:
    """rows (id, v) of one length."""
    n = rows.count()
    halves = [F.sum(F.shiftright("x", 20)).alias("high"), F.sum(F.col("x").bitwiseAND(0xFFFFF)).alias("low")]
    places = rows.select(F.posexplode("v").alias("place", "x")).groupBy("place").agg(*halves).orderBy("place").collect()
    centre = Centre(n, [(r["high"] << 20) + r["low"] for r in places])
    values, vectors, _ = leading_eigenvectors(lambda block: covariance_product(rows, centre, block), dimensions, components)
    some = values > max(values[0], 0) * LEAST_VARIANCE
    if not some.any():
        return None
    values, vectors = values[some], vectors[:, some]
    scaled = vectors / np.sqrt(values)
    trace = float(_added(rows, lambda points: np.atleast_2d((centre.centred(points) ** 2).sum()), (1, 1))[0, 0]) / n

    def squares(points: np.ndarray) -> np.ndarray:
        w = centre.centred(points) @ scaled
        return w.T @ w

    k = len(values)
    error = float(np.abs(_added(rows, squares, (k, k)) / n - np.eye(k)).max())
    explained = values / trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from stelae.llm import kdfilter

        for batch in batches:
            for i in range(0, len(batch), 1024):
                part = batch.slice(i, 1024)
                points = kdfilter.as_matrix(part.column("v"))
                w = centre.centred(points) @ scaled
                deviations = centre.deviations(points)
                row = np.repeat(np.arange(len(part)), k)
                yield pa.RecordBatch.from_pydict({
                    "id": part.column("id").take(pa.array(row)),
                    "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(part))),
                    "n": pa.array(np.full(len(row), n)),
                    "deviation": pa.array([d if d < 1 << 63 else None for d in deviations], pa.int64()).take(pa.array(row)),
                    "whitened": pa.array(w.reshape(-1)),
                    "explained": pa.array(np.tile(explained, len(part))),
                    "identity_error": pa.array(np.full(len(row), error)),
                    "deviation_text": pa.array([str(d) for d in deviations]).take(pa.array(row)),
                })

    return rows.mapInArrow(run, OUT)


def whiten(
    vectors: DataFrame, components: int, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 64, shift: int = 1_000_000
) -> DataFrame:
    """-> id, component (from 1, by falling variance), n, deviation, whitened, explained
    (share of the whole variance), identity_error, deviation_text."""
    spark = vectors.sparkSession
    ship_package(spark)
    found = kdfilter.scaled_vectors(vectors, id_col, vector_col, scale, LARGEST)
    rows = stored(found.select("id", F.transform("v", lambda x: x + shift).alias("v")), "vectors")
    # One length for each kind of embedding.
    lengths = sorted(r["width"] for r in rows.groupBy(F.size("v").alias("width")).count().collect())
    parts = [_whiten_length(rows.where(F.size("v") == w), w, components) for w in lengths if w]
    parts = [p for p in parts if p is not None]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], OUT)
