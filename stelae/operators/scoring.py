"""Scores of admitted cards with their neighbours' votes, checks of pools, and what a run of
judgments says about retrieval."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stelae.functions import scalars as S


def earned(shares: DataFrame) -> DataFrame:
    """shares (subject, class, share) -> the classes that earn the subject's vote: those of
    its greatest share, all of them where several tie."""
    most = shares.groupBy("subject").agg(F.max("share").alias("most"))
    return shares.join(most, "subject").where("share = most and share > 0").select("subject", "class")


def score_candidates(admitted: DataFrame, slots: DataFrame, domain_shares: DataFrame, range_shares: DataFrame, k: int) -> DataFrame:
    """admitted (subject, card, own_votes, card_cosine, best_cosine), slots (card, slot, base),
    shares (subject, class, share) of the neighbours that hold the subject and of those it
    refers to -> the best k of each subject: domain_vote and range_vote (1 if the card's
    domain or range earns it), their shares, score (with the own votes) and rank; ties by
    the shares' sum, the cosines, then the id. A card without exactly one domain, or with
    several ranges, fails the job."""
    if k < 1:
        raise ValueError("k must be at least 1")
    place = slots.where(F.col("slot").isin("DOMAIN", "RANGE")).groupBy("card").agg(
        F.count_distinct(F.when(F.col("slot") == "DOMAIN", F.col("base"))).alias("domains"), F.max(F.when(F.col("slot") == "DOMAIN", F.col("base"))).alias("domain"),
        F.count_distinct(F.when(F.col("slot") == "RANGE", F.col("base"))).alias("ranges"), F.max(F.when(F.col("slot") == "RANGE", F.col("base"))).alias("range"),
    )
    rows = admitted.join(place, "card", "left")
    wrong = (F.coalesce("domains", F.lit(0)) != 1) | (F.coalesce("ranges", F.lit(0)) > 1)
    said = F.raise_error(F.concat(F.lit("not one domain and at most one range: card "), F.col("card").cast("string")))
    rows = rows.withColumn("domain", F.when(wrong, said).otherwise(F.col("domain"))).drop("domains", "ranges")
    for side, shares in (("domain", domain_shares), ("range", range_shares)):
        held = shares.select("subject", F.col("class").alias(side), F.col("share").alias(f"{side}_share"))
        won = earned(shares).select("subject", F.col("class").alias(side), F.lit(1).alias(f"{side}_vote"))
        rows = rows.join(held, ["subject", side], "left").join(won, ["subject", side], "left").fillna(0, [f"{side}_share", f"{side}_vote"])
    rows = rows.withColumn("score", F.col("own_votes") + F.col("domain_vote") + F.col("range_vote"))
    order = [F.desc("score"), F.desc(F.col("domain_share") + F.col("range_share")), F.desc("card_cosine"), F.desc("best_cosine"), "card"]
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("subject").orderBy(*order))).where(F.col("rank") <= k)


def pool_faults(pool: DataFrame, k: int) -> DataFrame:
    """pool (subject, card, rank, cosine) -> subject, fault: a card seated twice, ranks that
    aren't 1 to their number, more than k seats, a cosine that is no number or falls as
    ranks rise the wrong way."""
    order = Window.partitionBy("subject").orderBy("rank")
    rows = pool.withColumn("before", F.lag("cosine").over(order))
    bad = F.col("cosine").isNull() | F.isnan("cosine") | (F.abs("cosine") == float("inf"))
    found = rows.groupBy("subject").agg(
        (F.count(F.lit(1)) > F.count_distinct("card")).alias("a card twice"),
        ((F.min("rank") != 1) | (F.max("rank") != F.count(F.lit(1))) | (F.count_distinct("rank") != F.count(F.lit(1)))).alias("ranks with gaps"),
        (F.count(F.lit(1)) > k).alias("too many seats"), F.bool_or(bad).alias("a cosine that is no number"), F.bool_or(F.coalesce(F.col("cosine") > F.col("before"), F.lit(False))).alias("cosines out of order"),
    )
    names = [c for c in found.columns if c != "subject"]
    listed = F.explode(F.array_compact(F.array(*[F.when(F.col(f"`{c}`"), F.lit(c)) for c in names])))
    return found.select("subject", listed.alias("fault"))


def retrieval_report(decisions: DataFrame, pool: DataFrame, cutoff: int) -> DataFrame:
    """decisions (decision, outcome: pick, abstention or else; choice), pool (decision, card,
    cosine, nominated) -> metric, value. Ranks are by cosine, not as shown. A rescue is a
    winner with a nomination from beyond the cutoff: only the nomination brought it in. The
    median is the upper one. Every count is of all decisions or pools."""
    ranked = pool.withColumn("rank", F.row_number().over(Window.partitionBy("decision").orderBy(F.desc("cosine"), "card")))
    picks = decisions.where("outcome = 'pick'")
    won = picks.join(ranked, (picks["decision"] == ranked["decision"]) & (picks["choice"] == ranked["card"]), "left").select(picks["decision"], "rank", "nominated")
    size = pool.groupBy("decision").agg(F.count(F.lit(1)).alias("size"), F.count_if("nominated").alias("nominated"))
    count = lambda condition: F.count_if(condition).cast("double")
    n = F.count(F.lit(1)).cast("double")
    rows = F.col("rank")
    winners = won.agg(
        n.alias("picks"), count(rows.isNull()).alias("picks outside their pool"), count(rows == 1).alias("first by cosine"), count(rows <= cutoff).alias("within the cutoff"),
        count((rows > cutoff) & F.col("nominated")).alias("rescues"), count("nominated").alias("winners with a nomination"),
        *[count(rows.isNotNull() & (S.rank_bucket(rows) == b)).alias(f"rank {b}") for b in ("1", "2-3", "4-10", "11-15", "16+")],
    )
    pools = size.agg(
        n.alias("pools"), F.min("size").cast("double").alias("least pool"), F.max("size").cast("double").alias("largest pool"), F.round(F.avg("size"), 1).alias("mean pool"),
        F.round(F.avg("nominated"), 1).alias("mean nominated"), count(F.col("nominated") == 0).alias("pools without nomination"),
    )
    # The upper median from the counts of sizes, not from the sizes of all pools.
    sizes = size.groupBy("size").agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy(F.lit(0))
    sums = sizes.withColumns({"upto": F.sum("n").over(whole.orderBy("size")), "all": F.sum("n").over(whole)})
    median = sums.where(F.col("upto") > F.floor(F.col("all") / 2)).agg(F.min("size").cast("double").alias("median pool"))
    outcomes = decisions.groupBy("outcome").agg(n.alias("value")).select(F.concat(F.lit("outcome "), "outcome").alias("metric"), "value")
    for table in (winners, pools, median):
        entries = F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(f"`{c}`").alias("value")) for c in table.columns]))
        outcomes = outcomes.unionByName(table.select(entries.alias("x")).select("x.*"))
    return outcomes
