"""Gates, audits, caches and further reads."""

from __future__ import annotations

from pyspark.sql import functions as F

from stelae.functions import scalars as S
from stelae.operators import bridge, compare, gates
from stelae.plans.model import GRAPH_SQL, Tables, edges, nodes
from stelae.plans.registry import query


def _count():
    return F.count(F.lit(1))


@query(GRAPH_SQL + "SELECT stable_id, role FROM nodes WHERE role IN ('root', 'class')")
def role_filter(t: Tables):
    return nodes(t).where(F.col("role").isin("root", "class")).select("stable_id", "role")


@query(GRAPH_SQL + "SELECT from_id, to_id FROM edges WHERE type IN ('HAS_CLASS', 'HAS_PROPERTY')")
def edge_type_alternation(t: Tables):
    return edges(t).where(F.col("type").isin("HAS_CLASS", "HAS_PROPERTY")).select("from_id", "to_id")


@query("""SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'exactMatch' WHEN '2-HIGH' THEN 'closeMatch' WHEN '5-LOW' THEN 'refused' ELSE 'unmapped' END AS predicate FROM orders""")
def predicate_source(t: Tables):
    labels = [("1-URGENT", "exactMatch"), ("2-HIGH", "closeMatch"), ("5-LOW", "refused")]
    rules = [(name, F.col("o_orderpriority") == label) for label, name in labels]
    return t.orders.select("o_orderkey", bridge.first_match(rules, "unmapped").alias("predicate"))


@query("""SELECT p_brand AS container, p_type AS type, count(*) AS members, min(p_partkey) AS first FROM part GROUP BY ALL""")
def target_index(t: Tables):
    return t.part.groupBy(F.col("p_brand").alias("container"), F.col("p_type").alias("type")).agg(
        _count().alias("members"), F.min("p_partkey").alias("first")
    )


@query("""SELECT event_id, spend FROM events LEFT JOIN (SELECT user_id AS u, round(sum(value), 4) AS spend FROM events WHERE event_type = 'purchase' GROUP BY 1) ON u = user_id""")
def judgment_cache_spend(t: Tables):
    spend = t.events.where("event_type = 'purchase'").groupBy("user_id").agg(F.round(F.sum("value"), 4).alias("spend"))
    return t.events.select("event_id", "user_id").join(spend, "user_id", "left").select("event_id", "spend")


@query("""SELECT a.l_orderkey, a.l_linenumber, b.l_linenumber AS other FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_suppkey = b.l_suppkey AND a.l_linenumber < b.l_linenumber""")
def curated_two_column_join(t: Tables):
    other = t.lineitem.select("l_orderkey", "l_suppkey", F.col("l_linenumber").alias("other"))
    rows = t.lineitem.select("l_orderkey", "l_suppkey", "l_linenumber").join(other, ["l_orderkey", "l_suppkey"])
    return rows.where("l_linenumber < other").drop("l_suppkey")


@query("""SELECT block, p_name FROM (SELECT DISTINCT p_brand AS block FROM part) JOIN part ON p_brand = block AND p_partkey = (SELECT min(p.p_partkey) FROM part p WHERE p.p_brand = block)""")
def card_probe(t: Tables):
    return t.part.groupBy(F.col("p_brand").alias("block")).agg(F.min_by("p_name", "p_partkey").alias("p_name"))


@query("""WITH f AS (SELECT source || '/' || lang AS path, string_agg(sha256(text), chr(10) ORDER BY doc_id) AS body FROM documents GROUP BY 1)
SELECT count(*) AS files, sha256(string_agg(path || ':' || sha256(body), chr(10) ORDER BY path)) AS fingerprint FROM f""")
def tree_fingerprint(t: Tables):
    listed = F.array_sort(F.collect_list(F.struct("doc_id", F.sha2("text", 256).alias("h"))))
    body = F.array_join(F.transform(listed, lambda x: x["h"]), "\n")
    files = t.documents.groupBy(F.concat_ws("/", "source", "lang").alias("path")).agg(F.sha2(body, 256).alias("h"))
    lines = F.array_sort(F.collect_list(F.concat_ws(":", "path", "h")))
    return files.agg(_count().alias("files"), F.sha2(F.array_join(lines, "\n"), 256).alias("fingerprint"))


@query("""SELECT element, raters, choices, round(most / raters, 4) AS agreement FROM (SELECT element, max(n) AS most, count(*) AS choices FROM
(SELECT l_partkey AS element, l_returnflag AS choice, count(DISTINCT l_suppkey) AS n FROM lineitem GROUP BY ALL) GROUP BY 1)
JOIN (SELECT l_partkey AS element, count(DISTINCT l_suppkey) AS raters FROM lineitem GROUP BY 1) USING (element) WHERE raters > 1""")
def inter_rater_summary(t: Tables):
    answers = t.lineitem.select(F.col("l_partkey").alias("element"), F.col("l_suppkey").alias("rater"), F.col("l_returnflag").alias("choice"))
    return gates.inter_rater(answers)


@query("""SELECT role, count(*) AS answers, count(DISTINCT conv_id) AS units, count(*) FILTER (WHERE length(text) < 50) AS unsure FROM conversations GROUP BY 1""")
def rater_set_census(t: Tables):
    return t.conversations.groupBy("role").agg(
        _count().alias("answers"), F.countDistinct("conv_id").alias("units"), F.count_if(F.length("text") < 50).alias("unsure")
    )


@query("""SELECT brand, p_type, place FROM (SELECT p_brand AS brand, p_type, n, row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, p_type)::INTEGER AS place
FROM (SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY ALL)) WHERE place <= 5""")
def top_classes_in_trace(t: Tables):
    counts = t.part.groupBy(F.col("p_brand").alias("brand"), "p_type").agg(_count().alias("n"))
    return gates.top_n(counts, "brand", [F.desc("n"), "p_type"], 5).select("brand", "p_type", "place")


@query("""SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, -o_orderkey)) AS block FROM orders GROUP BY 1""")
def name_lookup_newest(t: Tables):
    return gates.newest(t.orders, "o_custkey", "o_orderdate", "o_orderkey").select("o_custkey", F.col("o_orderkey").alias("block"))


@query("""SELECT DISTINCT p_name AS name FROM part WHERE p_name NOT IN (SELECT p_name FROM part WHERE p_size < 3) AND NOT regexp_matches(p_name, 'ring$')""")
def schema_residue(t: Tables):
    live = t.part.select(F.col("p_name").alias("name"))
    return gates.residue(live, t.part.where("p_size < 3").select(F.col("p_name").alias("name")), ["ring$"])


@query("""SELECT c_custkey, n_name AS owner FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey""")
def owner_definition(t: Tables):
    owners = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("owner"))
    return t.customer.join(owners, "c_nationkey", "left").select("c_custkey", "owner")


@query("""SELECT l_orderkey, CASE WHEN count(DISTINCT l_partkey) = 1 THEN max(l_partkey)::VARCHAR ELSE string_agg(DISTINCT l_partkey::VARCHAR, ',' ORDER BY l_partkey::VARCHAR) END AS range,
count(DISTINCT l_partkey) = 1 AS single FROM lineitem GROUP BY 1""")
def range_addressing(t: Tables):
    held = t.lineitem.groupBy("l_orderkey").agg(F.array_sort(F.collect_set(F.col("l_partkey").cast("string"))).alias("r"))
    return held.select("l_orderkey", S.unwrap(F.col("r")).alias("range"), (F.size("r") == 1).alias("single"))


@query("""SELECT n_name AS standard, count(DISTINCT c_mktsegment) AS dictionary, count(c_custkey) AS claims FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY 1""")
def self_documentation(t: Tables):
    rows = t.nation.join(t.customer, t.nation.n_nationkey == t.customer.c_nationkey, "left").groupBy(F.col("n_name").alias("standard"))
    return rows.agg(F.countDistinct("c_mktsegment").alias("dictionary"), F.count("c_custkey").alias("claims"))


@query("""SELECT DISTINCT text FROM documents WHERE source <> 'src0' AND text NOT IN (SELECT text FROM documents WHERE source = 'src0')""")
def embed_cache_misses(t: Tables):
    docs = t.documents.select("text", "source")
    return gates.cache_misses(docs.where("source <> 'src0'"), docs.where("source = 'src0'"), "text")


@query("SELECT l_orderkey, l_linenumber, l_extendedprice::FLOAT::DOUBLE AS narrowed FROM lineitem")
def float_narrowing(t: Tables):
    return t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_extendedprice").cast("float").cast("double").alias("narrowed"))


@query("""SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 0.95 WHEN 'O' THEN 0.8 ELSE NULL END::DOUBLE AS confidence FROM orders""")
def confidence_band(t: Tables):
    category = F.when(F.col("o_orderstatus") == "F", "exact").when(F.col("o_orderstatus") == "O", "close")
    return t.orders.select("o_orderkey", S.confidence_band(category).alias("confidence"))


@query("""SELECT rule, count(*) AS n FROM (SELECT 'tier' AS rule FROM lineitem WHERE NOT (l_returnflag IN ('A', 'R')) UNION ALL
SELECT 'quantity' FROM lineitem WHERE NOT (l_quantity < 45) UNION ALL SELECT 'ordinal' FROM lineitem WHERE NOT (l_linenumber > 0)) GROUP BY 1""")
def shape_validation(t: Tables):
    rules = {"tier": F.col("l_returnflag").isin("A", "R"), "quantity": F.col("l_quantity") < 45, "ordinal": F.col("l_linenumber") > 0}
    return gates.shape_violations(t.lineitem, "l_orderkey", rules).groupBy("rule").agg(_count().alias("n"))


@query("""SELECT 'priced' AS conjunct, count(*) FILTER (WHERE NOT o_totalprice > 0) = 0 AS passed, count(*) FILTER (WHERE NOT o_totalprice > 0) AS failures FROM orders
UNION ALL SELECT 'final', count(*) FILTER (WHERE o_orderstatus <> 'F') = 0, count(*) FILTER (WHERE o_orderstatus <> 'F') FROM orders""")
def gate_evaluation(t: Tables):
    return gates.gate(t.orders, {"priced": F.col("o_totalprice") > 0, "final": F.col("o_orderstatus") == "F"})


@query("""SELECT l_orderkey AS layer, l_returnflag AS version, count(*) AS cited FROM lineitem GROUP BY ALL
HAVING count(*) = (SELECT max(n) FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_returnflag))""")
def largest_layer_versions(t: Tables):
    counts = t.lineitem.groupBy(F.col("l_orderkey").alias("layer"), F.col("l_returnflag").alias("version")).agg(_count().alias("cited"))
    most = counts.agg(F.max("cited").alias("most"))
    return counts.join(F.broadcast(most), counts.cited == F.col("most")).drop("most")  # one row


@query("""SELECT l_orderkey, count(*) FILTER (WHERE l_discount = 0) AS debug_edges, count(*) AS edges FROM lineitem GROUP BY 1 HAVING count(*) FILTER (WHERE l_discount = 0) > 0""")
def debug_edge_audit(t: Tables):
    found = t.lineitem.groupBy("l_orderkey").agg(F.count_if(F.col("l_discount") == 0).alias("debug_edges"), _count().alias("edges"))
    return found.where("debug_edges > 0")


@query("""SELECT l_suppkey::VARCHAR AS subject, l_partkey::VARCHAR AS object FROM lineitem WHERE l_quantity > 5 GROUP BY ALL
UNION ALL SELECT l_suppkey::VARCHAR, 'NoTermFound' FROM lineitem GROUP BY 1 HAVING max(l_quantity) <= 5""")
def assertions_from_blocks(t: Tables):
    rows = t.lineitem.select(F.col("l_suppkey").cast("string").alias("subject"), F.col("l_partkey").cast("string").alias("object"), "l_quantity")
    mapped = rows.where("l_quantity > 5").select("subject", "object").distinct()
    gone = rows.select("subject").distinct().join(mapped.select("subject"), "subject", "left_anti")
    return mapped.unionByName(gone.withColumn("object", F.lit("NoTermFound")))


@query("""SELECT sha256(concat_ws(chr(31), p_name, p_type, p_size::VARCHAR)) AS digest, count(*) AS n, min(p_partkey) AS first FROM part GROUP BY 1""")
def structural_digest(t: Tables):
    digest = compare.record_hash([F.col(c) for c in ("p_name", "p_type", "p_size")]).alias("digest")
    return t.part.groupBy(digest).agg(_count().alias("n"), F.min("p_partkey").alias("first"))


@query(r"""SELECT page_id, regexp_extract(url, '^https?://([^/?#]+)', 1) AS family, coalesce(nullif(regexp_extract(url, '/(\d+)(?:[?#].*)?$', 1), ''), '-1')::INTEGER AS edition FROM pages""")
def edition_parse(t: Tables):
    edition = F.nullif(F.regexp_extract("url", r"/(\d+)(?:[?#].*)?$", 1), F.lit(""))
    edition = F.coalesce(edition, F.lit("-1")).cast("int")
    return t.pages.select("page_id", F.regexp_extract("url", "^https?://([^/?#]+)", 1).alias("family"), edition.alias("edition"))


@query("""SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING'""")
def user_role_filter(t: Tables):
    return t.customer.where("c_mktsegment = 'BUILDING'").orderBy(F.lower("c_name")).select("c_custkey", "c_name")
