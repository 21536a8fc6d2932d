"""Bounded samples of labelled rows for the classifiers, and their held-out fold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5
#: Bytes of a labelled text that a classifier learns from, at most.
TRAINING_BYTES = 1 << 17


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text is divisible by FOLDS; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> tuple[DataFrame | None, dict]:
    """Rows of docs with their label (0 or 1): for each class at most ``per_class``
    labelled ids outside the held-out fold, drawn by a hash of the id; and how many
    ids of each class there are. The drawn ids (2 x per_class at most) are broadcast;
    of them, documents of up to TRAINING_BYTES are learned from, so that what is
    gathered is bounded in bytes too."""
    known = labels.where(~held_out(F.col("doc_id")) & F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    drawn = []
    for y in sorted(counts):
        drawn += known.where(F.col("label") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class).collect()
    if not drawn:
        return None, counts
    spark = docs.sparkSession
    ids = spark.createDataFrame([(r["doc_id"], r["label"]) for r in drawn], known.schema)
    short = docs.where(F.coalesce(F.octet_length("text"), F.lit(0)) <= TRAINING_BYTES)
    rows = short.join(F.broadcast(ids), "doc_id").dropDuplicates(["doc_id"])
    return rows, counts


def constant(counts: dict) -> float | None:
    """The score where only one class, or none, can be learned from."""
    if counts.get(0) and counts.get(1):
        return None
    return 1.0 if counts.get(1) else 0.0
