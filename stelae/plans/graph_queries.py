"""Graph scans, joins, degrees, reachability and comparison over the model."""

from __future__ import annotations

from pyspark.sql import functions as F

from stelae.functions import scalars as S
from stelae.operators import compare, graph
from stelae.plans.model import GRAPH_SQL, Tables, edges, nodes
from stelae.plans.registry import query


@query(GRAPH_SQL + "SELECT stable_id, role, name FROM nodes WHERE source = 'geo'")
def node_scan_by_source(t: Tables):
    return graph.nodes_of_source(nodes(t), "geo").select("stable_id", "role", "name")


@query(GRAPH_SQL + "SELECT stable_id, name FROM nodes WHERE source = 'crm' AND (role IS NULL OR role <> 'root')")
def source_record_scan(t: Tables):
    return graph.source_records(nodes(t), "crm", "root").select("stable_id", "name")


@query("SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING' AND c_nationkey < 10")
def node_scan_all_labels(t: Tables):
    labels = F.array(F.col("c_mktsegment"), F.when(F.col("c_nationkey") < 10, "low").otherwise("high"))
    return graph.with_all_labels(t.customer.withColumn("labels", labels), ["BUILDING", "low"]).select("c_custkey")


@query(GRAPH_SQL + """SELECT e.type, e.from_id, e.to_id FROM edges e JOIN nodes a ON a.stable_id = e.from_id
JOIN nodes b ON b.stable_id = e.to_id WHERE a.source = 'geo' AND b.source = 'geo'""")
def edges_intra_source(t: Tables):
    return graph.edges_within(edges(t), nodes(t), "geo").select("type", "from_id", "to_id")


@query(GRAPH_SQL + """SELECT e.type, e.from_id, e.to_id, a.source AS from_source, b.source AS to_source FROM edges e
JOIN nodes a ON a.stable_id = e.from_id JOIN nodes b ON b.stable_id = e.to_id
WHERE a.source IN ('scm', 'cat') AND b.source IN ('scm', 'cat') AND a.source <> b.source""")
def edges_cross_source(t: Tables):
    return graph.edges_across(edges(t), nodes(t), ("scm", "cat"))


@query("""SELECT o_custkey % 20 AS bucket, count(*) AS n_edges, count(c_custkey) AS n_resolved FROM orders
LEFT JOIN customer ON c_custkey = o_custkey AND c_mktsegment <> 'MACHINERY' GROUP BY 1""")
def edge_endpoint_resolution(t: Tables):
    orders = t.orders.select(F.lit("PLACED_BY").alias("type"), F.col("o_orderkey").cast("string").alias("from_id"), F.concat(F.lit("c"), "o_custkey").alias("to_id"), "o_custkey")
    ends = t.orders.select(F.col("o_orderkey").cast("string").alias("stable_id")).unionByName(
        t.customer.where("c_mktsegment <> 'MACHINERY'").select(F.concat(F.lit("c"), "c_custkey").alias("stable_id"))
    )
    done = graph.resolve(orders, ends).groupBy((F.col("o_custkey") % 20).alias("bucket"))
    return done.agg(F.count(F.lit(1)).alias("n_edges"), F.count_if("resolved").alias("n_resolved"))


@query("""SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN
(SELECT c_custkey FROM customer WHERE c_mktsegment <> 'MACHINERY')""")
def dangling_edges(t: Tables):
    kept = t.customer.where("c_mktsegment <> 'MACHINERY'").select(F.col("c_custkey").alias("o_custkey"))
    return t.orders.join(kept, "o_custkey", "left_anti").select("o_orderkey", "o_custkey")


@query("""SELECT l_partkey AS part, arg_max(l_returnflag, l_orderkey * 10 + l_linenumber) AS flag,
arg_max(l_quantity, l_orderkey * 10 + l_linenumber) AS quantity FROM lineitem GROUP BY 1""")
def node_upsert_later_wins(t: Tables):
    versions = t.lineitem.select(
        F.col("l_partkey").alias("part"), F.col("l_returnflag").alias("flag"), F.col("l_quantity").alias("quantity"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("position"),
    )
    return graph.upsert(versions, "part", "position", ["flag", "quantity"])


@query("SELECT DISTINCT 'SUPPLIES' AS type, l_suppkey AS from_id, l_partkey AS to_id FROM lineitem")
def edge_dedup(t: Tables):
    rows = t.lineitem.select(F.lit("SUPPLIES").alias("type"), F.col("l_suppkey").alias("from_id"), F.col("l_partkey").alias("to_id"))
    return graph.unique_edges(rows)


@query(GRAPH_SQL + """SELECT n.stable_id, (SELECT count(*) FROM edges e WHERE e.to_id = n.stable_id) AS in_degree,
(SELECT count(*) FROM edges e WHERE e.from_id = n.stable_id) AS out_degree FROM nodes n""")
def node_degrees(t: Tables):
    return graph.degrees(nodes(t), edges(t)).select("stable_id", "in_degree", "out_degree")


@query(GRAPH_SQL + """, r AS (SELECT stable_id, 0 AS depth FROM nodes WHERE role = 'root' UNION
SELECT e.to_id, r.depth + 1 FROM r JOIN edges e ON e.from_id = r.stable_id WHERE r.depth < 14)
SELECT stable_id, min(depth)::INTEGER AS depth FROM r GROUP BY 1""")
def root_reachability(t: Tables):
    n = nodes(t)
    return graph.reach(edges(t), n.where("role = 'root'"))


@query(GRAPH_SQL + """, r AS (SELECT stable_id FROM nodes WHERE stable_id = 'region:0' UNION
SELECT e.to_id FROM r JOIN edges e ON e.from_id = r.stable_id)
SELECT stable_id, role FROM nodes WHERE stable_id NOT IN (SELECT stable_id FROM r)""")
def unreached_nodes(t: Tables):
    n = nodes(t)
    return graph.unreached(n, graph.reach(edges(t), n.where("stable_id = 'region:0'"))).select("stable_id", "role")


@query(GRAPH_SQL + """SELECT n.role, count(*) AS n_nodes, count(o.to_id) AS n_owned FROM nodes n LEFT JOIN
(SELECT to_id FROM edges WHERE type = 'HAS_PROPERTY' GROUP BY 1 HAVING count(DISTINCT from_id) = 1) o
ON o.to_id = n.stable_id GROUP BY 1""")
def exactly_one_owner(t: Tables):
    found = graph.owners(nodes(t), edges(t), "HAS_PROPERTY").groupBy("role")
    return found.agg(F.count(F.lit(1)).alias("n_nodes"), F.count_if("one_owner").alias("n_owned"))


@query(GRAPH_SQL + "SELECT source, role, count(*) AS n, count(DISTINCT name) AS n_names FROM nodes GROUP BY ALL")
def role_census(t: Tables):
    return nodes(t).groupBy("source", "role").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("name").alias("n_names"))


@query(GRAPH_SQL + """SELECT type, a.source AS from_source, b.source AS to_source, count(*) AS n FROM edges e
JOIN nodes a ON a.stable_id = e.from_id JOIN nodes b ON b.stable_id = e.to_id GROUP BY ALL""")
def edge_census(t: Tables):
    return graph.with_ends(edges(t), nodes(t)).groupBy("type", "from_source", "to_source").agg(F.count(F.lit(1)).alias("n"))


@query(GRAPH_SQL + """, own AS (SELECT to_id AS id, from_id AS owner FROM edges WHERE type = 'HAS_PROPERTY')
SELECT id AS stable_id, count(*) AS n FROM (SELECT id, owner AS x FROM own
UNION SELECT a.id, b.id FROM own a JOIN own b USING (owner) WHERE a.id <> b.id
UNION SELECT from_id, to_id FROM edges WHERE type <> 'HAS_PROPERTY') GROUP BY 1""")
def neighbour_set(t: Tables):
    return graph.neighbour_counts(edges(t), "HAS_PROPERTY")


@query("""SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS ordinal,
count(*) OVER (PARTITION BY conv_id) AS siblings FROM conversations""")
def sequence_ordinal(t: Tables):
    found = graph.sibling_ordinal(t.conversations.select("conv_id", "turn"), "conv_id", ["turn"])
    return found.withColumn("ordinal", F.col("ordinal").cast("long"))


@query("""SELECT a.l_orderkey AS step, b.l_orderkey AS prerequisite FROM lineitem a JOIN lineitem b
ON a.l_partkey = b.l_partkey AND a.l_linenumber = 1 AND b.l_linenumber = 2 WHERE b.l_orderkey > a.l_orderkey GROUP BY ALL""")
def numbering_linearization(t: Tables):
    steps = t.orders.select(F.col("o_orderkey").alias("step"), F.col("o_orderkey").alias("number"))
    makes = t.lineitem.where("l_linenumber = 2").select("l_partkey", F.col("l_orderkey").alias("prerequisite"))
    takes = t.lineitem.where("l_linenumber = 1").select("l_partkey", F.col("l_orderkey").alias("step"))
    needs = takes.join(makes, "l_partkey").select("step", "prerequisite").distinct()
    return graph.linear_violations(steps, needs).select("step", "prerequisite")


@query("""SELECT coalesce(a.k, b.k) AS k, CASE WHEN b.k IS NULL THEN 'missing' ELSE 'extra' END AS side
FROM (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'F') a
FULL JOIN (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'O') b ON a.k = b.k WHERE a.k IS NULL OR b.k IS NULL""")
def diff_sets(t: Tables):
    rows = t.orders.select(F.col("o_custkey").alias("k"), "o_orderstatus")
    return compare.diff_sets(rows.where("o_orderstatus = 'F'"), rows.where("o_orderstatus = 'O'"), "k")


@query("""SELECT a.k, (a.n - coalesce(b.n, 0))::BIGINT AS surplus FROM
(SELECT l_suppkey AS k, count(*) AS n FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1) a LEFT JOIN
(SELECT l_suppkey AS k, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) b ON a.k = b.k
WHERE a.n > coalesce(b.n, 0)""")
def bag_surplus(t: Tables):
    rows = t.lineitem.select(F.col("l_suppkey").alias("k"), "l_returnflag")
    return compare.bag_surplus(rows.where("l_returnflag = 'A'"), rows.where("l_returnflag = 'R'"), "k")


@query("""SELECT coalesce(a.k, b.k) AS k, CASE WHEN b.k IS NULL THEN 'only_in_a' WHEN a.k IS NULL THEN 'only_in_b'
WHEN a.q <> b.q THEN 'changed' ELSE 'same' END AS verdict
FROM (SELECT l_orderkey AS k, l_quantity AS q FROM lineitem WHERE l_linenumber = 1) a
FULL JOIN (SELECT l_orderkey AS k, l_quantity AS q FROM lineitem WHERE l_linenumber = 2) b ON a.k = b.k""")
def record_set_compare(t: Tables):
    rows = t.lineitem.select(F.col("l_orderkey").alias("k"), F.col("l_quantity").alias("q"), "l_linenumber")
    return compare.compare_records(rows.where("l_linenumber = 1"), rows.where("l_linenumber = 2"), "k", ["q"])


@query("""SELECT verdict, count(*) AS n FROM (SELECT CASE WHEN a.s IS NOT NULL AND b.s IS NOT NULL THEN 'matched'
WHEN a.s IS NULL THEN 'invented' WHEN c.s IS NOT NULL THEN 'omitted' ELSE 'lost' END AS verdict
FROM (SELECT DISTINCT p_partkey || '|' || p_brand AS s FROM part) a
FULL JOIN (SELECT DISTINCT p_partkey || '|' || CASE WHEN p_size > 45 THEN 'x' ELSE p_brand END AS s FROM part WHERE p_size > 3) b ON a.s = b.s
LEFT JOIN (SELECT DISTINCT p_partkey || '|' || p_brand AS s FROM part WHERE p_size <= 2) c ON c.s = a.s) GROUP BY 1""")
def statement_diff(t: Tables):
    made = lambda value: F.concat_ws("|", F.col("p_partkey").cast("string"), value).alias("statement")
    brand, size = F.col("p_brand"), F.col("p_size")
    graph_side = t.part.where(size > 3).select(made(F.when(size > 45, "x").otherwise(brand)))
    found = compare.statement_diff(t.part.select(made(brand)), graph_side, t.part.where(size <= 2).select(made(brand)))
    return found.groupBy("verdict").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH h AS (SELECT sha256(concat_ws(chr(31), n_nationkey::VARCHAR, n_name)) AS h FROM nation),
b AS (SELECT substr(h, 1, 2) AS lead, count(*) AS n, count(DISTINCT h) AS d, min(h) AS low, max(h) AS high FROM h GROUP BY 1)
SELECT sum(n)::BIGINT AS n_rows, sum(d)::BIGINT AS n_distinct,
sha256(string_agg(concat_ws(':', lead, n::VARCHAR, d::VARCHAR, low, high), chr(10) ORDER BY lead)) AS fingerprint FROM b""")
def table_fingerprint(t: Tables):
    return compare.table_fingerprint(t.nation, ["n_nationkey", "n_name"])


@query("""WITH h AS (SELECT sha256(concat_ws(chr(31), l_orderkey::VARCHAR, l_linenumber::VARCHAR, l_partkey::VARCHAR, l_returnflag)) AS h FROM lineitem),
p AS (SELECT h, '0x' || substr(h, 1, 8) AS a, '0x' || substr(h, 9, 8) AS b, '0x' || substr(h, 17, 8) AS c, '0x' || substr(h, 25, 8) AS d,
'0x' || substr(h, 33, 8) AS e, '0x' || substr(h, 41, 8) AS f, '0x' || substr(h, 49, 8) AS g, '0x' || substr(h, 57, 8) AS i FROM h),
b AS (SELECT substr(h, 1, 2) AS lead, count(*) AS n, count(DISTINCT h) AS d, min(h) AS low, max(h) AS high,
concat_ws(':', sum(a::BIGINT), sum(b::BIGINT), sum(c::BIGINT), sum(d::BIGINT), sum(e::BIGINT), sum(f::BIGINT), sum(g::BIGINT), sum(i::BIGINT)) AS sums FROM p GROUP BY 1)
SELECT sum(n)::BIGINT AS n_rows, sum(d)::BIGINT AS n_distinct,
sha256(string_agg(concat_ws(':', lead, n::VARCHAR, d::VARCHAR, low, high, CASE WHEN n > 2 THEN sums END), chr(10) ORDER BY lead)) AS fingerprint FROM b""")
def table_fingerprint_lines(t: Tables):
    return compare.table_fingerprint(t.lineitem, ["l_orderkey", "l_linenumber", "l_partkey", "l_returnflag"])


@query("""WITH s AS (SELECT o_orderstatus AS "set", o_orderpriority AS p FROM orders WHERE o_totalprice > 300000 GROUP BY ALL),
c AS (SELECT "set" AS k, count(*) AS n FROM s GROUP BY 1)
SELECT s."set", m.o_custkey AS customer FROM s JOIN (SELECT DISTINCT o_custkey, o_orderpriority AS p FROM orders) m ON m.p = s.p
JOIN c ON c.k = s."set" GROUP BY s."set", m.o_custkey HAVING count(*) = max(c.n)""")
def manifest_division(t: Tables):
    priority = F.col("o_orderpriority").alias("key")
    sets = t.orders.where("o_totalprice > 300000").select(F.col("o_orderstatus").alias("set"), priority)
    return compare.contains_all(t.orders.select(F.col("o_custkey").alias("customer"), priority), sets, "customer", "key")


@query("""SELECT 'e' AS type, sha256('SUPPLIES' || '␟' || l_suppkey || '␟' || l_partkey || '␟' || 'flag=' || l_returnflag || '␟' ||
'line=' || l_linenumber) AS identity FROM lineitem""")
def edge_identity(t: Tables):
    props = F.create_map(F.lit("line"), F.col("l_linenumber").cast("string"), F.lit("flag"), F.col("l_returnflag"))
    text = S.edge_identity(F.lit("SUPPLIES"), F.col("l_suppkey").cast("string"), F.col("l_partkey").cast("string"), props)
    return t.lineitem.select(F.lit("e").alias("type"), F.sha2(text, 256).alias("identity"))


@query("""SELECT l_orderkey AS subject, l_partkey AS object, count(DISTINCT l_returnflag) AS n_predicates, count(*) AS n
FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def edge_uniqueness(t: Tables):
    rows = t.lineitem.groupBy(F.col("l_orderkey").alias("subject"), F.col("l_partkey").alias("object"))
    found = rows.agg(F.countDistinct("l_returnflag").alias("n_predicates"), F.count(F.lit(1)).alias("n"))
    return found.where("n > 1")


@query("""SELECT l_suppkey AS part_of, count(*) AS n_nodes, count(DISTINCT l_partkey) AS n_ids,
sum(CASE WHEN l_returnflag IS NULL OR l_quantity > 49 THEN 1 ELSE 0 END)::BIGINT AS n_uncovered FROM lineitem GROUP BY 1""")
def coverage_gate(t: Tables):
    return t.lineitem.groupBy(F.col("l_suppkey").alias("part_of")).agg(
        F.count(F.lit(1)).alias("n_nodes"),
        F.countDistinct("l_partkey").alias("n_ids"),
        F.count_if(F.col("l_returnflag").isNull() | (F.col("l_quantity") > 49)).alias("n_uncovered"),
    )
