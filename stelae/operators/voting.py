"""The voting walk: from a subject's texts over their hits to cards, and the seats that the
best cards get.

A path goes subject - text - hit text - base - slot - card. A card is admitted by at least
one path through an admitting slot; its votes are the subject's texts that reach it by
any path. Admitted cards are ordered by votes, then by the best cosine between one of the
subject's texts and the whole card, then by their best path, then by id. The best k of a
subject are found by ranks that Spark limits before rows are shuffled (each task hands on
its own best k and what ties with them) and again after, so no task gathers a subject's
cards; the paths behind the seats are joined on at the end, as rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stelae.runtime import stored

#: The reasons for which a card may sit in a pool.
SEAT_REASONS = ("filteredOnKey", "filteredOnKeyAndTuple", "keyPoolOnSourceSideMismatch", "nominatedBy", "retrieval")


def walk(hits: DataFrame, described: DataFrame, slots: DataFrame) -> DataFrame:
    """hits (subject, text, hit_text, cosine), described (hit_text, base), slots (base,
    slot, card) -> a row for each path. Bases on no card reach nothing."""
    return hits.join(described, "hit_text").join(slots, "base").select("subject", "card", "text", "hit_text", "base", "slot", "cosine")


def repeated_texts(texts: DataFrame) -> DataFrame:
    """texts (subject, text): those that would vote twice."""
    return texts.groupBy("subject", "text").count().where("count > 1").drop("count")


def tally(paths: DataFrame, admitting: tuple[str, ...] = ("PROPERTY",)) -> DataFrame:
    """-> subject, card, own_votes (distinct texts), paths, best_cosine of any path; only
    cards with a path through an admitting slot."""
    # A row for each voting text first: distinct texts are then a plain count.
    by_text = paths.groupBy("subject", "card", "text").agg(
        F.count(F.lit(1)).alias("paths"), F.max("cosine").alias("best"), F.count_if(F.col("slot").isin(*admitting)).alias("admitting")
    )
    found = by_text.groupBy("subject", "card").agg(
        F.count(F.lit(1)).alias("own_votes"), F.sum("paths").alias("paths"), F.max("best").alias("best_cosine"), F.sum("admitting").alias("admitting")
    )
    return found.where("admitting > 0").drop("admitting")


def _norm(vector: str):
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def card_texts(admitted: DataFrame, texts: DataFrame, cards: DataFrame) -> DataFrame:
    """admitted (subject, card, ...), texts (subject, text, vector), cards (card, vector)
    -> admitted with card_cosine and best_text: the subject's text nearest to the whole
    card, of equally near ones the least. Vectors without length have no cosine. An
    admitted card without a comparable text or vector fails the job: it must not pass for
    a card that was compared and lost."""
    whole = cards.select("card", F.col("vector").alias("whole"), _norm("vector").alias("whole_norm"))
    own = texts.select("subject", "text", "vector", _norm("vector").alias("norm"))
    pairs = admitted.select("subject", "card").join(whole, "card").join(own, "subject")
    product = F.aggregate(F.zip_with("vector", "whole", lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
    scored = pairs.select("subject", "card", "text", (product / F.nullif(F.col("norm") * F.col("whole_norm"), F.lit(0.0))).alias("cosine"))
    # The least of (-cosine, text) is the greatest cosine with its least text.
    near = F.min(F.when(F.col("cosine").isNotNull(), F.struct((-F.col("cosine")).alias("far"), "text"))).alias("near")
    found = admitted.join(scored.groupBy("subject", "card").agg(near), ["subject", "card"], "left")
    name = F.concat(F.lit("no vector to compare: card "), F.coalesce(F.col("card").cast("string"), F.lit("null")))
    cosine = F.when(F.col("near").isNotNull(), -F.col("near.far")).otherwise(F.raise_error(name))
    return found.withColumns({"card_cosine": cosine, "best_text": F.col("near.text")}).drop("near")


def seats(scored: DataFrame, k: int) -> DataFrame:
    """scored (subject, card, own_votes, card_cosine, best_cosine, ...) -> the best k of
    each subject with seat (1 to k), tie_class (cards of one class differ by id alone), ties
    (cards of that class) and cut (the class goes on beyond the last seat)."""
    if k < 1:
        raise ValueError("k must be at least 1")
    score = [F.desc("own_votes"), F.desc("card_cosine"), F.desc("best_cosine")]
    by_score, by_card = Window.partitionBy("subject").orderBy(*score), Window.partitionBy("subject").orderBy(*score, "card")
    place = Window.partitionBy("subject", "own_votes", "card_cosine", "best_cosine")
    # The rank's limit is applied in each task before the shuffle. It keeps whole classes.
    near = scored.withColumn("tie_class", F.rank().over(by_score)).where(F.col("tie_class") <= k)
    near = near.withColumns({"ties": F.count(F.lit(1)).over(place), "seat": F.row_number().over(by_card)}).where(F.col("seat") <= k)
    return near.withColumn("cut", F.col("tie_class") + F.col("ties") - 1 > k)


def evidence(paths: DataFrame, seated: DataFrame) -> DataFrame:
    """The paths behind the seats, numbered in each seat by text, hit text, base and slot."""
    order = Window.partitionBy("subject", "card").orderBy("text", "hit_text", "base", "slot")
    found = paths.join(seated.select("subject", "card", "seat"), ["subject", "card"])
    return found.withColumn("place", F.row_number().over(order))


def vote(hits, described, slots, texts, cards, k: int, admitting: tuple[str, ...] = ("PROPERTY",)) -> tuple[DataFrame, DataFrame]:
    """-> (seats, paths); both from a stored walk, which is made once."""
    paths = stored(walk(hits, described, slots), "paths")
    return seats(card_texts(tally(paths, admitting), texts, cards), k), paths


def unlisted_reasons(pool: DataFrame, reason: str = "seat_reason") -> DataFrame:
    """Rows of a pool whose reason isn't one of the list, or is absent."""
    return pool.where(~F.coalesce(F.col(reason).isin(*SEAT_REASONS), F.lit(False)))


def rendering_ties(pool: DataFrame, truth: DataFrame) -> DataFrame:
    """pool (subject, card, text as shown to the judge), truth (subject, card) -> subjects
    of which some true card in the pool was shown in the same words as another card there;
    with shown_alike, the number of such true cards. Counts of texts, no pairs of cards."""
    true = truth.select("subject", "card").distinct().withColumn("true", F.lit(True))
    marked = pool.select("subject", "card", "text").distinct().where("text is not null").join(true, ["subject", "card"], "left")
    shown = marked.groupBy("subject", "text").agg(F.count(F.lit(1)).alias("cards"), F.count("true").alias("n_true"))
    return shown.where("cards > 1 and n_true > 0").groupBy("subject").agg(F.sum("n_true").alias("shown_alike"))
