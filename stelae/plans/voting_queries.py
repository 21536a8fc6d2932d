"""The voting walk over suppliers (subjects), their orders (texts), parts (hits) and brands
and types (cards)."""

from __future__ import annotations

from pyspark.sql import functions as F

from stelae.operators import voting
from stelae.plans.model import Tables
from stelae.plans.registry import query

K = 5

VOTE_SQL = f"""WITH slots AS (SELECT p_partkey AS base, CASE WHEN p_size > 25 THEN 'PROPERTY' ELSE 'RANGE' END AS slot, p_brand AS card FROM part
  UNION ALL SELECT p_partkey, 'CLASS', p_type FROM part),
paths AS (SELECT l_suppkey AS subject, card, l_orderkey AS text, l_partkey AS hit_text, base, slot, 1 - l_discount AS cosine
  FROM lineitem JOIN slots ON base = l_partkey),
admitted AS (SELECT subject, card, count(DISTINCT text) AS own_votes, count(*) AS paths, max(cosine) AS best_cosine FROM paths
  GROUP BY 1, 2 HAVING count(*) FILTER (WHERE slot = 'PROPERTY') > 0),
texts AS (SELECT l_suppkey AS subject, l_orderkey AS text, [sum(l_quantity), sum(l_linenumber)::DOUBLE, count(*)::DOUBLE] AS v FROM lineitem GROUP BY 1, 2),
cards AS (SELECT p_brand AS card, [sum(p_size)::DOUBLE, count(*)::DOUBLE, count(*) FILTER (WHERE p_type LIKE 'ECONOMY%')::DOUBLE] AS w FROM part GROUP BY 1),
scored AS (SELECT subject, card, text, list_inner_product(v, w) / (sqrt(list_inner_product(v, v)) * sqrt(list_inner_product(w, w))) AS c
  FROM admitted JOIN texts USING (subject) JOIN cards USING (card)),
best AS (SELECT subject, card, max(c) AS card_cosine FROM scored GROUP BY 1, 2),
told AS (SELECT subject, card, card_cosine, min(text) AS best_text FROM best JOIN scored USING (subject, card) WHERE c = card_cosine GROUP BY ALL),
ranked AS (SELECT *, rank() OVER (PARTITION BY subject ORDER BY own_votes DESC, card_cosine DESC, best_cosine DESC) AS tie_class,
  count(*) OVER (PARTITION BY subject, own_votes, card_cosine, best_cosine) AS ties,
  row_number() OVER (PARTITION BY subject ORDER BY own_votes DESC, card_cosine DESC, best_cosine DESC, card) AS seat
  FROM admitted JOIN told USING (subject, card)),
seats AS (SELECT *, tie_class + ties - 1 > {K} AS cut FROM ranked WHERE seat <= {K})
"""


def _vote(t: Tables):
    hits = t.lineitem.select(
        F.col("l_suppkey").alias("subject"), F.col("l_orderkey").alias("text"), F.col("l_partkey").alias("hit_text"), (1 - F.col("l_discount")).alias("cosine")
    )
    described = t.part.select(F.col("p_partkey").alias("hit_text"), F.col("p_partkey").alias("base"))
    brand = F.struct(F.when(F.col("p_size") > 25, "PROPERTY").otherwise("RANGE").alias("slot"), F.col("p_brand").alias("card"))
    kind = F.struct(F.lit("CLASS").alias("slot"), F.col("p_type").alias("card"))
    slots = t.part.select(F.col("p_partkey").alias("base"), F.inline(F.array(brand, kind)))
    number = lambda c: c.cast("double")
    texts = t.lineitem.groupBy(F.col("l_suppkey").alias("subject"), F.col("l_orderkey").alias("text")).agg(
        F.array(F.sum("l_quantity"), number(F.sum("l_linenumber")), number(F.count(F.lit(1)))).alias("vector")
    )
    cards = t.part.groupBy(F.col("p_brand").alias("card")).agg(
        F.array(number(F.sum("p_size")), number(F.count(F.lit(1))), number(F.count_if(F.col("p_type").startswith("ECONOMY")))).alias("vector")
    )
    return voting.vote(hits, described, slots, texts, cards, K)


@query(VOTE_SQL + """SELECT subject, card, seat, tie_class, ties, cut, own_votes, paths, round(best_cosine, 6) AS best_cosine,
round(card_cosine, 6) AS card_cosine, best_text FROM seats""")
def voted_seats(t: Tables):
    seated, _ = _vote(t)
    return seated.withColumns({"best_cosine": F.round("best_cosine", 6), "card_cosine": F.round("card_cosine", 6)})


@query(VOTE_SQL + """SELECT subject, seat, row_number() OVER (PARTITION BY subject, card ORDER BY text, hit_text, base, slot) AS place, text, hit_text, slot
FROM paths JOIN seats USING (subject, card)""")
def seat_evidence(t: Tables):
    seated, paths = _vote(t)
    return voting.evidence(paths, seated).select("subject", "seat", "place", "text", "hit_text", "slot")


@query(VOTE_SQL + """, shown AS (SELECT subject, card, left(card, 7) AS words FROM seats),
truth AS (SELECT DISTINCT l_suppkey AS subject, p_brand AS card FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_discount = 0.1 AND l_quantity = 50)
SELECT a.subject, count(*) AS shown_alike FROM shown a JOIN truth USING (subject, card)
WHERE EXISTS (SELECT 1 FROM shown b WHERE b.subject = a.subject AND b.card <> a.card AND b.words = a.words) GROUP BY 1""")
def rendering_ties(t: Tables):
    seated, _ = _vote(t)
    truth = t.lineitem.where("l_discount = 0.1 and l_quantity = 50").join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    pool = seated.select("subject", "card", F.substring("card", 1, 7).alias("text"))
    return voting.rendering_ties(pool, truth.select(F.col("l_suppkey").alias("subject"), F.col("p_brand").alias("card")))


@query("""WITH pool AS (SELECT event_id, CASE event_type WHEN 'click' THEN 'retrieval' WHEN 'view' THEN 'nominatedBy' WHEN 'purchase' THEN 'filteredOnKey'
  WHEN 'error' THEN NULL ELSE event_type END AS seat_reason FROM events)
SELECT seat_reason, count(*) AS n FROM pool
WHERE seat_reason IS NULL OR seat_reason NOT IN ('filteredOnKey', 'filteredOnKeyAndTuple', 'keyPoolOnSourceSideMismatch', 'nominatedBy', 'retrieval') GROUP BY 1""")
def seat_reasons_refused(t: Tables):
    kind = F.col("event_type")
    reason = F.when(kind == "click", "retrieval").when(kind == "view", "nominatedBy").when(kind == "purchase", "filteredOnKey")
    reason = reason.when(kind == "error", F.lit(None)).otherwise(kind)
    pool = t.events.select("event_id", reason.alias("seat_reason"))
    return voting.unlisted_reasons(pool).groupBy("seat_reason").agg(F.count(F.lit(1)).alias("n"))
