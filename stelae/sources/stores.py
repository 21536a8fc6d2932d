"""Append-only stores as tables of the shared folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def verified(rows: DataFrame, address: str, recomputed: Column) -> DataFrame:
    """Rows whose content address holds; any other fails the read."""
    wrong = F.raise_error(F.concat(F.lit("damaged content: "), F.coalesce(F.col(address), F.lit("no address"))))
    return rows.withColumn(address, F.when(recomputed.eqNullSafe(F.col(address)), F.col(address)).otherwise(wrong))


def append_numbered(store: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """The store and the new rows, which get the next numbers (seq) of their key."""
    last = store.groupBy(key).agg(F.max("seq").alias("last"))
    place = F.row_number().over(Window.partitionBy(key).orderBy(*[c for c in new.columns if c != key]))
    numbered = new.withColumn("place", place).join(last, key, "left")
    numbered = numbered.withColumn("seq", F.coalesce("last", F.lit(0)) + F.col("place")).drop("place", "last")
    return store.unionByName(numbered)


def first_written(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Of rows with equal keys, the first written stands."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    return rows.withColumn("place", place).where("place = 1").drop("place")


def save_objects(store: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Upsert by key with new columns added: new values win where they aren't null, and
    objects without a new column hold null in it."""
    both = store.withColumn("turn", F.lit(0)).unionByName(new.withColumn("turn", F.lit(1)), allowMissingColumns=True)
    columns = [c for c in both.columns if c not in (key, "turn")]
    return both.groupBy(key).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("turn"))).alias(c) for c in columns])


def sssom_lines(rows: DataFrame, header: dict[str, str], columns: list[str]) -> DataFrame:
    """Text lines of an SSSOM file in order (n, value): the header as comments, slots that
    hold one value for all rows moved into it, then the table."""
    constant = rows.agg(*[F.when(F.countDistinct(c) == 1, F.max(c)).alias(c) for c in columns]).first().asDict()
    moved = {c: v for c, v in constant.items() if v is not None}
    kept = [c for c in columns if c not in moved]
    top = [f"# {k}: {v}" for k, v in {**header, **moved}.items()] + ["\t".join(kept)]
    spark = rows.sparkSession
    head = spark.createDataFrame(list(enumerate(top)), "n bigint, value string")
    body = rows.select(F.lit(len(top)).cast("bigint").alias("n"), F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in kept]).alias("value"))
    return head.unionByName(body)
