"""Cards of a hub, scores with neighbours' votes, pools, and comparisons of graphs, blocks
and typed values."""

from __future__ import annotations

from pyspark.sql import functions as F

from stelae.operators import cards, compare, scoring
from stelae.plans.model import Tables
from stelae.plans.registry import query


def _text(column: str):
    return F.col(column).cast("string")


# --- cards


def _hub(t: Tables):
    size = F.col("p_size")
    domains = F.when(size == 3, F.lit(None)).when(size == 50, F.array("p_brand", F.lit("Nowhere"))).otherwise(F.array("p_brand", "p_brand"))
    ranges = F.when(size <= 5, F.array("p_type")).when(size == 6, F.array(F.lit("EMPTY"), F.lit("p_brand"))).when(size == 7, F.array("p_brand"))
    properties = t.part.select(F.concat(F.lit("p"), _text("p_partkey")).alias("property"), domains.alias("domains"), ranges.alias("ranges"))
    values = t.part.select(F.col("p_type").alias("option_set"), _text("p_size").alias("value")).unionByName(
        t.spark.createDataFrame([("EMPTY", None)], "option_set string, value string")
    )
    qualifiers = t.part.where("p_size in (4, 8)").select(F.concat(F.lit("p"), _text("p_partkey")).alias("property"), F.lit("q|1").alias("qualifier"))
    return cards.enumerate_cards(properties, t.part.select(F.col("p_brand").alias("id")), values, qualifiers)


CARD_SQL = """WITH placed AS (SELECT 'p' || p_partkey AS property, p_brand AS domain, p_size, p_type FROM part WHERE p_size <> 3),
values_ AS (SELECT DISTINCT p_type AS option_set, p_size::VARCHAR AS value FROM part),
bare AS (SELECT property, domain, '' AS option_set, '' AS value, p_size FROM placed UNION ALL
  SELECT property, domain, option_set, value, p_size FROM placed JOIN values_ ON option_set = p_type WHERE p_size <= 5),
c AS (SELECT *, '' AS qualifier FROM bare UNION ALL SELECT *, 'q|1' FROM bare WHERE p_size IN (4, 8))
"""


@query(CARD_SQL + """SELECT property || '|' || domain || '|' || option_set || '|' || value || '|' || qualifier AS card,
CASE value WHEN '' THEN 'property' ELSE 'optionValue' END AS tier FROM c""")
def hub_cards(t: Tables):
    return _hub(t)[0].select("card", "tier")


@query(CARD_SQL + """SELECT slot, base, count(*) AS cards FROM (SELECT 'PROPERTY' AS slot, property AS base FROM c UNION ALL SELECT 'DOMAIN', domain FROM c
UNION ALL SELECT 'RANGE', option_set FROM c UNION ALL SELECT 'VALUE', value FROM c UNION ALL SELECT 'QUALIFIER', qualifier FROM c) WHERE base <> '' GROUP BY ALL""")
def hub_card_edges(t: Tables):
    return _hub(t)[1].groupBy("slot", "base").agg(F.count(F.lit(1)).alias("cards"))


@query("""SELECT 'p' || p_partkey AS property, NULL AS at, 'no domain' AS reason FROM part WHERE p_size = 3
UNION ALL SELECT 'p' || p_partkey, 'Nowhere', 'a domain that is no class' FROM part WHERE p_size = 50
UNION ALL SELECT 'p' || p_partkey, 'EMPTY', 'an option set without values' FROM part WHERE p_size = 6
UNION ALL SELECT 'p' || p_partkey, 'p_brand', 'a range that is nothing known' FROM part WHERE p_size = 6""")
def hub_card_skips(t: Tables):
    return _hub(t)[2]


@query("""WITH said AS (SELECT DISTINCT p_name AS property, p_brand AS domain FROM part WHERE p_size > 10), drawn AS (SELECT DISTINCT p_name, p_brand FROM part WHERE p_size < 40)
SELECT *, 'only said' AS side FROM (FROM said EXCEPT FROM drawn) UNION ALL SELECT *, 'only drawn' FROM (FROM drawn EXCEPT FROM said)""")
def domain_addressing(t: Tables):
    properties = t.part.where("p_size > 10").select(F.col("p_name").alias("property"), F.array("p_brand").alias("domains"))
    edges = t.part.where("p_size < 40").select(F.col("p_brand").alias("from_id"), F.col("p_name").alias("to_id"))
    return cards.domain_disagreements(properties, edges)


# --- scores


@query("""WITH l AS (SELECT l_suppkey AS subject, l_orderkey, l_discount, l_tax, p_brand, p_type, p_brand || '/' || p_type AS card FROM lineitem JOIN part ON p_partkey = l_partkey),
a AS (SELECT subject, card, p_brand, p_type, count(DISTINCT l_orderkey) AS own_votes, max(l_discount) AS card_cosine, max(l_tax) AS best_cosine FROM l GROUP BY ALL),
n AS (SELECT subject, count(*) AS n FROM l GROUP BY 1),
d AS (SELECT subject, p_brand, count(*) / max(n) AS share FROM l JOIN n USING (subject) GROUP BY 1, 2),
r AS (SELECT subject, p_type, count(*) / max(n) AS share FROM l JOIN n USING (subject) GROUP BY 1, 2),
s AS (SELECT a.*, (d.share = max(d.share) OVER (PARTITION BY a.subject))::INTEGER AS domain_vote, (r.share = max(r.share) OVER (PARTITION BY a.subject))::INTEGER AS range_vote, d.share + r.share AS shares
  FROM a JOIN d USING (subject, p_brand) JOIN r USING (subject, p_type))
SELECT subject, card, score, domain_vote, range_vote, rank FROM (SELECT *, own_votes + domain_vote + range_vote AS score,
  row_number() OVER (PARTITION BY subject ORDER BY own_votes + domain_vote + range_vote DESC, shares DESC, card_cosine DESC, best_cosine DESC, card) AS rank FROM s) WHERE rank <= 7""")
def candidate_scores(t: Tables):
    name = F.concat_ws("/", "p_brand", "p_type").alias("card")
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(F.col("l_suppkey").alias("subject"), "l_orderkey", "l_discount", "l_tax", "p_brand", "p_type", name)
    admitted = rows.groupBy("subject", "card").agg(F.count_distinct("l_orderkey").alias("own_votes"), F.max("l_discount").alias("card_cosine"), F.max("l_tax").alias("best_cosine"))
    places = F.explode(F.array(F.struct(F.lit("DOMAIN").alias("slot"), F.col("p_brand").alias("base")), F.struct(F.lit("RANGE").alias("slot"), F.col("p_type").alias("base"))))
    slots = t.part.select(name, places.alias("x")).select("card", "x.*")
    whole = rows.groupBy("subject").agg(F.count(F.lit(1)).alias("n"))

    def shares(column: str):
        counted = rows.groupBy("subject", F.col(column).alias("class")).agg(F.count(F.lit(1)).alias("own")).join(whole, "subject")
        return counted.select("subject", "class", (F.col("own") / F.col("n")).alias("share"))

    found = scoring.score_candidates(admitted, slots, shares("p_brand"), shares("p_type"), 7)
    return found.select("subject", "card", "score", "domain_vote", "range_vote", "rank")


@query("""WITH p AS (SELECT l_suppkey AS subject, l_partkey AS card, l_linenumber AS rank, l_discount AS cosine FROM lineitem WHERE l_quantity = 7),
m AS (SELECT subject, count(*) AS n, count(DISTINCT card) AS cards, min(rank) AS low, max(rank) AS high, count(DISTINCT rank) AS ranks FROM p GROUP BY 1)
SELECT subject, 'a card twice' AS fault FROM m WHERE n > cards UNION ALL SELECT subject, 'ranks with gaps' FROM m WHERE low <> 1 OR high <> n OR ranks <> n
UNION ALL SELECT subject, 'too many seats' FROM m WHERE n > 3""")
def pool_validation(t: Tables):
    rows = t.lineitem.where("l_quantity = 7").select(F.col("l_suppkey").alias("subject"), F.col("l_partkey").alias("card"), F.col("l_linenumber").alias("rank"), F.lit(0.5).alias("cosine"))
    return scoring.pool_faults(rows, 3)


@query("""WITH pool AS (SELECT l_orderkey AS decision, l_partkey AS card, max(l_discount) AS cosine, bool_or(l_returnflag = 'R') AS nominated FROM lineitem GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY decision ORDER BY cosine DESC, card) AS rank FROM pool),
d AS (SELECT o_orderkey AS decision, CASE o_orderstatus WHEN 'F' THEN 'pick' WHEN 'O' THEN 'abstention' ELSE 'unrecognized' END AS outcome, choice FROM orders LEFT JOIN (SELECT decision, max(card) AS choice FROM pool GROUP BY 1) ON decision = o_orderkey),
w AS (SELECT rank, nominated FROM d LEFT JOIN r ON r.decision = d.decision AND r.card = d.choice WHERE outcome = 'pick'),
s AS (SELECT decision, count(*) AS size, count(*) FILTER (WHERE nominated) AS named FROM pool GROUP BY 1)
SELECT 'outcome ' || outcome AS metric, count(*)::DOUBLE AS value FROM d GROUP BY 1
UNION ALL SELECT unnest(['picks', 'picks outside their pool', 'first by cosine', 'within the cutoff', 'rescues', 'winners with a nomination', 'rank 1', 'rank 2-3', 'rank 4-10', 'rank 11-15', 'rank 16+']),
  unnest([count(*), count(*) FILTER (WHERE rank IS NULL), count(*) FILTER (WHERE rank = 1), count(*) FILTER (WHERE rank <= 2), count(*) FILTER (WHERE rank > 2 AND nominated), count(*) FILTER (WHERE nominated),
  count(*) FILTER (WHERE rank = 1), count(*) FILTER (WHERE rank IN (2, 3)), count(*) FILTER (WHERE rank BETWEEN 4 AND 10), count(*) FILTER (WHERE rank BETWEEN 11 AND 15), count(*) FILTER (WHERE rank > 15)])::DOUBLE FROM w
UNION ALL SELECT unnest(['pools', 'least pool', 'largest pool', 'mean pool', 'mean nominated', 'pools without nomination', 'median pool']),
  unnest([count(*)::DOUBLE, min(size), max(size), round(avg(size), 1), round(avg(named), 1), count(*) FILTER (WHERE named = 0), list_sort(list(size))[1 + count(*) // 2]]) FROM s""")
def retrieval_report(t: Tables):
    pool = t.lineitem.groupBy(F.col("l_orderkey").alias("decision"), F.col("l_partkey").alias("card")).agg(F.max("l_discount").alias("cosine"), F.bool_or(F.col("l_returnflag") == "R").alias("nominated"))
    choice = pool.groupBy("decision").agg(F.max("card").alias("choice"))
    outcome = F.when(F.col("o_orderstatus") == "F", "pick").when(F.col("o_orderstatus") == "O", "abstention").otherwise("unrecognized")
    decisions = t.orders.select(F.col("o_orderkey").alias("decision"), outcome.alias("outcome")).join(choice, "decision", "left")
    return scoring.retrieval_report(decisions, pool, 2)


# --- comparisons


@query("""WITH gn AS (SELECT c_custkey::VARCHAR AS id FROM customer), nn AS (SELECT DISTINCT o_custkey::VARCHAR FROM orders UNION SELECT 'new'),
ge AS (SELECT DISTINCT o_custkey || '>' || o_orderpriority FROM orders WHERE o_orderstatus = 'F'), ne AS (SELECT DISTINCT o_custkey || '>' || o_orderpriority FROM orders WHERE o_orderstatus = 'O')
SELECT 'nodes' AS what, *, 'missing' AS side FROM (FROM gn EXCEPT FROM nn) UNION ALL SELECT 'nodes', *, 'extra' FROM (FROM nn EXCEPT FROM gn)
UNION ALL SELECT 'edges', *, 'missing' FROM (FROM ge EXCEPT FROM ne) UNION ALL SELECT 'edges', *, 'extra' FROM (FROM ne EXCEPT FROM ge)""")
def graph_compare(t: Tables):
    key = F.concat_ws(">", _text("o_custkey"), "o_orderpriority").alias("id")
    extra = t.spark.createDataFrame([("new",)], "id string")
    new = t.orders.select(_text("o_custkey").alias("id")).unionByName(extra)
    return compare.compare_graphs(
        t.customer.select(_text("c_custkey").alias("id")), new, t.orders.where("o_orderstatus = 'F'").select(key), t.orders.where("o_orderstatus = 'O'").select(key), "id"
    )


@query("""WITH b AS (SELECT o_custkey AS pair, o_orderstatus AS s, arg_max(o_orderpriority, o_orderkey) AS priority, arg_max(floor(o_totalprice / 100000)::INTEGER, o_orderkey) AS band FROM orders GROUP BY 1, 2),
f AS (SELECT * FROM b WHERE s = 'F'), o AS (SELECT * FROM b WHERE s = 'O')
SELECT coalesce(f.pair, o.pair) AS pair, CASE WHEN f.pair IS NULL THEN 'CANDIDATE_ONLY' WHEN o.pair IS NULL THEN 'BASELINE_ONLY' WHEN f.priority = o.priority THEN 'ONLY_FINGERPRINT_DIFFERS' ELSE 'DIFFERENT' END AS verdict,
CASE WHEN f.pair IS NOT NULL AND o.pair IS NOT NULL AND f.priority <> o.priority THEN CASE WHEN f.band <> o.band THEN 'band' ELSE 'body' END END AS differing FROM f FULL JOIN o ON f.pair = o.pair""")
def block_compare(t: Tables):
    latest = t.orders.groupBy(F.col("o_custkey").alias("pair"), "o_orderstatus").agg(
        F.max_by("o_orderpriority", "o_orderkey").alias("priority"), F.max_by(F.floor(F.col("o_totalprice") / 100000).cast("int"), "o_orderkey").alias("band")
    )
    mark = F.concat(F.lit("print-"), "o_orderstatus")
    rows = latest.select("pair", "o_orderstatus", mark.alias("fingerprint"), F.concat(F.lit('{"made":"'), mark, F.lit('","body":"'), "priority", F.lit('"}')).alias("text"), "band")
    found = compare.compare_blocks(rows.where("o_orderstatus = 'F'"), rows.where("o_orderstatus = 'O'"), ["band"])
    return found.withColumn("differing", F.array_join("differing", ","))


@query("""SELECT c_custkey, '["map",[["c_mktsegment",["str","' || c_mktsegment || '"]],["held",["list",[["int","' || c_nationkey || '"],["null"]]]],["in",["bool",' || (c_acctbal < 0)::VARCHAR || ']]]]' AS value FROM customer""")
def typed_values(t: Tables):
    whole = F.struct(F.array("c_nationkey", F.lit(None)).alias("held"), "c_mktsegment", (F.col("c_acctbal") < 0).alias("in"))
    rows = t.customer.select("c_custkey", whole.alias("v"))
    return rows.select("c_custkey", compare.typed_value(F.col("v"), rows.schema["v"].dataType).alias("value"))


@query("""WITH h AS (SELECT sha256(l_orderkey || '|' || l_linenumber || '|' || l_partkey) AS h FROM lineitem),
p AS (SELECT substr(h, 1, 3) AS part, count(*) AS n, sha256(string_agg(h, chr(10) ORDER BY h)) AS d FROM h GROUP BY 1)
SELECT sum(n)::BIGINT AS n, sha256(string_agg(d, chr(10) ORDER BY part)) AS digest FROM p""")
def set_digest(t: Tables):
    h = F.sha2(F.concat_ws("|", _text("l_orderkey"), _text("l_linenumber"), _text("l_partkey")), 256).alias("h")
    return compare.set_digest(t.lineitem.select(h), "h")
