"""Exact vector retrieval and the votes built on it."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stelae.runtime import ship_package

#: Vectors of a block; subjects that are compared with a block at once.
BLOCK, SLICE = 4096, 512


def unfit_vectors(vectors: DataFrame, width: int) -> DataFrame:
    """Vectors that can't be indexed: absent, of another width, or not finite."""
    wrong = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.where(F.col("vector").isNull() | (F.size("vector") != width) | wrong)


def _fit(vectors: DataFrame) -> DataFrame:
    wrong = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.where(F.col("vector").isNotNull() & F.col("id").isNotNull() & ~wrong)


def _blocks(vectors: DataFrame, count: int, side: str) -> DataFrame:
    """One row per block: ids and a float64 matrix, as bytes."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("id", kind="stable")
        matrix = np.stack([np.asarray(v, np.float64) for v in group["vector"]])
        key = {c: [group[c].iloc[0]] for c in ("width", side)}
        return pd.DataFrame({**key, f"{side}_ids": [group["id"].tolist()], f"{side}_matrix": [matrix.tobytes()]})

    keyed = vectors.select("id", "vector", F.size("vector").alias("width"), F.pmod(F.xxhash64("id"), F.lit(count)).alias(side))
    return keyed.groupBy("width", side).applyInPandas(run, f"width int, {side} long, {side}_ids array<bigint>, {side}_matrix binary")


def _best(cosine: np.ndarray, who: np.ndarray, ids: np.ndarray, k: int, floor: float) -> pd.DataFrame:
    """subject, card, cosine: of each row the k highest that reach the floor, ties to the
    smaller id. Only what reaches a row's k-th highest is sorted."""
    least = np.full(len(cosine), float(floor))
    if cosine.shape[1] > k:
        least = np.maximum(least, np.partition(cosine, -k, axis=1)[:, -k])
    row, column = np.nonzero(cosine >= least[:, None])
    value = cosine[row, column]
    order = np.lexsort((ids[column], -value, row))
    row = row[order]
    kept = np.arange(len(row)) - np.searchsorted(row, row) < k
    row, order = row[kept], order[kept]
    return pd.DataFrame({"subject": who[row], "card": ids[column[order]], "cosine": value[order]})


def cosine_top_k(subjects: DataFrame, cards: DataFrame, k: int, floor: float, skip_own: bool = False) -> DataFrame:
    """subjects, cards (id long, vector) -> subject, card, cosine, rank: for each subject
    the k cards of highest cosine (raw, in double) that reach the floor, ties to the
    smaller id. Blocks of subjects meet blocks of cards; a subject's best of each block
    are ranked together. skip_own: a subject is no card of itself. Vectors of each length are
    compared with each other; those that can't be (null, empty, or holding null or
    non-finite components) take no part."""
    if k < 1:
        raise ValueError("k must be at least 1")
    ship_package(subjects.sparkSession)
    subjects, cards = (_fit(x).where("size(vector) > 0") for x in (subjects, cards))
    left, right = (max(1, -(-x.count() // BLOCK)) for x in (subjects, cards))
    asked = _blocks(subjects, left, "s").withColumn("c", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(right - 1).cast("long"))))
    pairs = asked.join(_blocks(cards, right, "c"), ["width", "c"])

    def run(frames):
        for frame in frames:
            for s_ids, s, c_ids, c in zip(frame.s_ids, frame.s_matrix, frame.c_ids, frame.c_matrix, strict=True):
                a = np.frombuffer(s, np.float64).reshape(len(s_ids), -1)
                b = np.frombuffer(c, np.float64).reshape(len(c_ids), -1)
                ids, who = np.asarray(c_ids), np.asarray(s_ids)
                b_norms = np.sqrt((b * b).sum(1))
                for at in range(0, len(a), SLICE):
                    part, own = a[at : at + SLICE], who[at : at + SLICE]
                    norms = np.sqrt((part * part).sum(1))[:, None] * b_norms[None, :]
                    cosine, real = part @ b.T, norms > 0
                    if real.all():
                        cosine /= norms
                    else:
                        cosine = np.divide(cosine, norms, out=np.full(norms.shape, -2.0), where=real)
                    if skip_own:
                        cosine[ids[None, :] == own[:, None]] = -np.inf
                    yield _best(cosine, own, ids, k, floor)

    found = pairs.select("s_ids", "s_matrix", "c_ids", "c_matrix").mapInPandas(run, "subject long, card long, cosine double")
    order = Window.partitionBy("subject").orderBy(F.desc("cosine"), "card")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def vote_pool(hits: DataFrame, slots: DataFrame) -> DataFrame:
    """hits (subject, text, base, cosine), slots (card, slot, base) -> subject, card,
    own_votes (distinct texts by the property slot), paths, best_cosine; only cards
    with a property path are admitted."""
    walked = hits.join(slots, "base")
    own = F.col("slot") == "PROPERTY"
    return (
        walked.groupBy("subject", "card")
        .agg(
            F.countDistinct(F.when(own, F.col("text"))).alias("own_votes"),
            F.count(F.lit(1)).alias("paths"),
            F.max(F.when(own, F.col("cosine"))).alias("best_cosine"),
        )
        .where("own_votes > 0")
    )


def class_shares(neighbours: DataFrame, named: DataFrame) -> DataFrame:
    """neighbours (subject, neighbour), named (neighbour, class) -> subject, class, share:
    distinct neighbours that name the class over all neighbours, silent ones included."""
    whole = neighbours.groupBy("subject").agg(F.countDistinct("neighbour").alias("n"))
    votes = neighbours.join(named, "neighbour").groupBy("subject", "class").agg(F.countDistinct("neighbour").alias("votes"))
    return votes.join(whole, "subject").select("subject", "class", (F.col("votes") / F.col("n")).alias("share"))


def top_share(shares: DataFrame) -> DataFrame:
    """The classes whose share is the subject's greatest."""
    most = F.max("share").over(Window.partitionBy("subject"))
    return shares.withColumn("most", most).where("share = most and share > 0").drop("most")


def recall_at(ranked: DataFrame, truth: DataFrame, cuts: list[int]) -> DataFrame:
    """ranked (subject, card, rank), truth (subject, card) -> k, found, subjects, recall."""
    first = truth.join(ranked, ["subject", "card"], "left").groupBy("subject").agg(F.min("rank").alias("rank"))
    cut = F.explode(F.array(*map(F.lit, cuts))).alias("k")
    return (
        first.select("subject", "rank", cut)
        .groupBy("k")
        .agg(F.count_if(F.col("rank") <= F.col("k")).alias("found"), F.count(F.lit(1)).alias("subjects"))
        .withColumn("recall", F.round(F.col("found") / F.col("subjects"), 4))
    )
