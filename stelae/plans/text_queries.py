"""Text index, composed texts, stable ids and debug judges over the model."""

from __future__ import annotations

from pyspark.sql import functions as F

from stelae.functions import scalars as S
from stelae.operators import bridge, fulltext
from stelae.plans.model import GRAPH_SQL, Tables, nodes
from stelae.plans.registry import query
from stelae.runtime import spread, stored


@query("""WITH w AS (SELECT p_partkey AS id, unnest(list_filter(string_split_regex(lower(p_name || ' ' || p_type), '[^a-z0-9]+'), lambda x: x <> '')) AS term FROM part),
d AS (SELECT id, count(*) AS length FROM w GROUP BY 1), p AS (SELECT term, id, count(*) AS tf FROM w GROUP BY ALL),
f AS (SELECT term, count(*) AS df FROM p GROUP BY 1), n AS (SELECT count(*) AS n, avg(length) AS a FROM d),
s AS (SELECT q.id AS query, p.id, round(sum(ln(1 + (n.n - f.df + 0.5) / (f.df + 0.5)) * p.tf * 2.2 / (p.tf + 1.2 * (0.25 + 0.75 * d.length / n.a))), 6) AS score
FROM (SELECT DISTINCT id, term FROM w WHERE id % 100 = 0) q JOIN f USING (term) JOIN p USING (term) JOIN d ON d.id = p.id, n GROUP BY ALL)
SELECT query, id, rank, round(score, 4) AS score FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, id)::INTEGER AS rank FROM s) WHERE rank <= 5""")
def fulltext_bm25(t: Tables):
    docs = t.part.select(F.col("p_partkey").alias("id"), F.concat_ws(" ", "p_name", "p_type").alias("text"))
    index = stored(fulltext.postings(spread(docs, "id")), "postings")
    n, total = index.agg(F.countDistinct("id"), F.sum("tf")).first()
    asked = docs.where("id % 100 = 0").select(F.col("id").alias("query"), "text")
    found = fulltext.bm25_top_k(index, n, (total or 0) / max(1, n), asked, 5)
    return found.select("query", "id", "rank", F.round("score", 4).alias("score"))


@query(GRAPH_SQL + "SELECT split_part(stable_id, ':', 1) AS prefix, role, count(*) AS n FROM nodes GROUP BY ALL")
def stable_id_prefixes(t: Tables):
    return nodes(t).groupBy(S.id_prefix(F.col("stable_id")).alias("prefix"), "role").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT p_partkey, trim(regexp_replace(concat_ws(' · ', nullif(trim(p_name), ''), nullif(trim(p_brand), ''), nullif(trim(p_type), '')), '\\s+', ' ', 'g')) AS text FROM part""")
def composed_embed_text(t: Tables):
    return t.part.select("p_partkey", S.compose_text(F.col("p_name"), F.col("p_brand"), F.col("p_type")).alias("text"))


@query("""SELECT o_orderkey, CASE WHEN count(l_linenumber) > 0 THEN 1 ELSE 0 END::BIGINT AS first, 0::BIGINT AS abstains
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1""")
def debug_judges(t: Tables):
    pools = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("pool"))
    rows = t.orders.select("o_orderkey").join(pools, "o_orderkey", "left").withColumn("pool", F.coalesce("pool", F.lit(0)))
    return rows.select("o_orderkey", bridge.first_judge(F.col("pool")).alias("first"), bridge.abstaining_judge().alias("abstains"))


@query("""SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_suppkey, l_linenumber) - 1 AS place FROM lineitem""")
def planned_edge_order(t: Tables):
    rows = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    return bridge.planned_order(rows, ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]).select("l_orderkey", "l_linenumber", "place")


@query("SELECT c_custkey, c_mktsegment AS wrapped, c_mktsegment AS first FROM customer")
def property_wrap(t: Tables):
    rows = t.customer.select("c_custkey", S.wrap(F.col("c_mktsegment")).alias("held"))
    return rows.select("c_custkey", S.unwrap(F.col("held")).alias("wrapped"), S.first_of_list(F.col("held")).alias("first"))
