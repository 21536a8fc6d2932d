"""How far two orders of the same rows disagree."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stelae.runtime import ship_package, stored


def count_inversions(values: np.ndarray, group: np.ndarray | None = None) -> int:
    """Pairs (i, j) of one group with i before j and values[i] > values[j], bit by bit of
    the values' ranks: within equal higher bits, ones that come before zeros."""
    if len(values) < 2:
        return 0
    rank = np.unique(values, return_inverse=True)[1].astype(np.int64)
    bits = int(rank.max()).bit_length()
    if group is not None:
        rank |= np.unique(group, return_inverse=True)[1].astype(np.int64) << bits
    total = 0
    for bit in range(bits):
        prefix = rank >> (bit + 1)
        order = np.argsort(prefix, kind="stable")
        ones = rank[order] >> bit & 1
        before = np.cumsum(ones) - ones
        prefix = prefix[order]
        first = np.flatnonzero(np.r_[True, prefix[1:] != prefix[:-1]])
        before -= np.repeat(before[first], np.diff(np.r_[first, len(prefix)]))
        total += int(before[ones == 0].sum())
    return total


def inversions(rows: DataFrame, one: str, two: str) -> int:
    """Pairs of rows that the columns ``one`` and ``two`` (whole numbers) put in opposite
    orders; equal values and nulls oppose nothing. Rows are cut into ranges of either
    column, as many as the third root of the rows. Pairs that differ in both ranges are
    counted from the ranges' counts alone, the others within each range, so that a task
    holds one range and no pair of rows is ever made."""
    ship_package(rows.sparkSession)
    rows = rows.select(F.col(one).cast("long").alias("x"), F.col(two).cast("long").alias("y")).dropna()
    n = rows.count()
    k = max(1, round(n ** (1 / 3)))
    rows = stored(rows.repartitionByRange(k, "x").withColumn("a", F.spark_partition_id()), "ranges")
    rows = stored(rows.repartitionByRange(k, "y").withColumn("b", F.spark_partition_id()), "ranges")

    def within(columns: list[str], cells: bool):
        def run(group: pd.DataFrame) -> pd.DataFrame:
            from stelae.operators.inversions import count_inversions

            group = group.sort_values(columns)  # equal ones in rising order oppose nothing
            y = group[columns[1]].to_numpy()
            found = count_inversions(y) - (count_inversions(y, group["b"].to_numpy()) if cells else 0)
            return pd.DataFrame({"n": [found]})

        return run

    # A pair of one cell is counted in its range of x and in its range of y: once too often.
    by_x = rows.groupBy("a").applyInPandas(within(["x", "y"], True), "n long")
    by_y = rows.groupBy("b").applyInPandas(within(["x", "y"], False), "n long")
    grid = rows.sparkSession.range(k * k).select((F.col("id") / k).cast("int").alias("a"), (F.col("id") % k).cast("int").alias("b"))
    grid = grid.join(rows.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")), ["a", "b"], "left").fillna(0, ["n"])
    lower = Window.partitionBy("b").orderBy("a").rowsBetween(Window.unboundedPreceding, -1)
    above = Window.partitionBy("a").orderBy(F.desc("b")).rowsBetween(Window.unboundedPreceding, -1)
    grid = grid.withColumn("under", F.coalesce(F.sum("n").over(lower), F.lit(0)))
    across = grid.select((F.col("n") * F.coalesce(F.sum("under").over(above), F.lit(0))).alias("n"))
    return int(by_x.unionByName(by_y).unionByName(across).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])


def numbered(rows: DataFrame, order: list[str], number: str, after: int = 0) -> DataFrame:
    """Rows numbered from after + 1 in order, by ranges: each range is counted, and its
    rows go on from the ranges before it."""
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    dealt = stored(dealt.withColumns({"range_of": F.spark_partition_id(), number: place}), "numbered")
    sizes = {r["range_of"]: r["count"] for r in dealt.groupBy("range_of").count().collect()}
    begin, starts = after + 1, []
    for k in sorted(sizes):
        starts.append((k, begin))
        begin += sizes[k]
    starts = rows.sparkSession.createDataFrame(starts, "range_of int, begin long")
    return dealt.join(F.broadcast(starts), "range_of").withColumn(number, F.col(number) + F.col("begin")).drop("range_of", "begin")
