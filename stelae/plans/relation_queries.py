"""Published relations, rollups, ledgers, layers, gates and event logs."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from stelae.functions import scalars as S
from stelae.operators import bridge, compare
from stelae.plans.model import Tables
from stelae.plans.registry import query


def _n():
    return F.count(F.lit(1))



@query("SELECT o_orderkey, l_linenumber AS position, l_partkey FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey")
def manifest_members_left_join(t: Tables):
    return t.orders.join(t.lineitem, t.orders.o_orderkey == t.lineitem.l_orderkey, "left").select(
        "o_orderkey", F.col("l_linenumber").alias("position"), "l_partkey"
    )


@query("""SELECT l_partkey AS block, count(DISTINCT l_orderkey) AS n, string_agg(DISTINCT l_orderkey::VARCHAR, ',' ORDER BY l_orderkey::VARCHAR) AS manifests
FROM lineitem GROUP BY 1""")
def group_concat_members(t: Tables):
    found = t.lineitem.groupBy(F.col("l_partkey").alias("block"))
    listed = F.array_join(F.array_sort(F.collect_set(F.col("l_orderkey").cast("string"))), ",")
    return found.agg(F.countDistinct("l_orderkey").alias("n"), listed.alias("manifests"))


@query("""SELECT o_orderkey, sha256(string_agg(l_partkey::VARCHAR, chr(10) ORDER BY l_linenumber, l_partkey)) AS manifest_key
FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1""")
def manifest_key(t: Tables):
    members = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey")))
    text = F.array_join(F.transform(members, lambda m: m["l_partkey"].cast("string")), "\n")
    keys = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sha2(text, 256).alias("manifest_key"))
    return keys.join(t.orders.select("o_orderkey"), "o_orderkey", "left_semi")


@query("""SELECT p_partkey, coalesce(own.q, ref.q) AS q, own.q IS NOT NULL AS from_own FROM part
LEFT JOIN (SELECT l_partkey, max(l_quantity) AS q FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) own ON own.l_partkey = p_partkey
LEFT JOIN (SELECT l_partkey, max(l_quantity) AS q FROM lineitem GROUP BY 1) ref ON ref.l_partkey = p_partkey""")
def layered_lookup(t: Tables):
    def most(rows, name):
        return rows.groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.max("l_quantity").alias(name))

    own, reference = most(t.lineitem.where("l_returnflag = 'R'"), "own"), most(t.lineitem, "reference")
    rows = t.part.select("p_partkey").join(own, "p_partkey", "left").join(reference, "p_partkey", "left")
    return rows.select("p_partkey", F.coalesce("own", "reference").alias("q"), F.col("own").isNotNull().alias("from_own"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 50 OFFSET 50")
def manifest_page(t: Tables):
    rows = bridge.page(t.orders, [F.desc("o_orderdate"), "o_orderkey"], 2, 50)
    return rows.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))


@query("""SELECT strftime(ts, '%Y-%m-%d') AS day, event_type AS recipe, count(*) AS builds, round(sum(value), 4) AS usd FROM events GROUP BY ALL""")
def spend_by_day(t: Tables):
    day = F.date_format("ts", "yyyy-MM-dd").alias("day")
    return t.events.groupBy(day, F.col("event_type").alias("recipe")).agg(_n().alias("builds"), F.round(F.sum("value"), 4).alias("usd"))


@query("""SELECT event_type, (user_id % 5)::VARCHAR AS provider, count(*) AS calls, round(sum(value), 4) AS usd FROM events
GROUP BY CUBE (event_type, (user_id % 5)::VARCHAR)""")
def spend_rollup(t: Tables):
    rows = t.events.select("event_type", (F.col("user_id") % 5).cast("string").alias("provider"), "value")
    return rows.cube("event_type", "provider").agg(_n().alias("calls"), F.round(F.sum("value"), 4).alias("usd"))


@query("""SELECT user_id, k, count(*) AS n, round(sum(value), 4) AS usd FROM (SELECT user_id, value, json_extract_string(props, '$.k')::INTEGER AS k FROM events)
WHERE k IS NOT NULL GROUP BY ALL""")
def spend_by_property(t: Tables):
    k = F.get_json_object("props", "$.k").cast("int").alias("k")
    rows = t.events.select("user_id", "value", k).where("k is not null")
    return rows.groupBy("user_id", "k").agg(_n().alias("n"), F.round(F.sum("value"), 4).alias("usd"))


@query("""SELECT user_id, arg_max(event_type, event_id) AS status, max(event_id) AS row_id FROM events GROUP BY 1""")
def latest_status(t: Tables):
    return bridge.latest(t.events, "user_id", "event_id").select("user_id", F.col("event_type").alias("status"), F.col("event_id").alias("row_id"))


@query("""SELECT l_partkey AS block, arg_min(l_orderkey, (o_orderdate, l_orderkey)) AS version FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1""")
def first_publisher(t: Tables):
    rows = t.lineitem.join(t.orders, t.lineitem.l_orderkey == t.orders.o_orderkey)
    first = F.min(F.struct("o_orderdate", "l_orderkey"))["l_orderkey"].alias("version")
    return rows.groupBy(F.col("l_partkey").alias("block")).agg(first)


@query("""SELECT event_type, round(avg(value), 6) AS mean, round(median(value), 6) AS median, min(value) AS least, max(value) AS most FROM events GROUP BY 1""")
def retrieval_metrics(t: Tables):
    return t.events.groupBy("event_type").agg(
        F.round(F.avg("value"), 6).alias("mean"), F.round(F.median("value"), 6).alias("median"),
        F.min("value").alias("least"), F.max("value").alias("most"),
    )


@query("""SELECT l_suppkey AS layer, l_returnflag AS version, count(*) AS n_rows, count(*) FILTER (WHERE l_discount > 0) AS mapped,
round(count(*) FILTER (WHERE l_discount = 0) / count(*), 4) AS abstention FROM lineitem GROUP BY ALL""")
def layer_version_counts(t: Tables):
    none = F.count_if(F.col("l_discount") == 0)
    return t.lineitem.groupBy(F.col("l_suppkey").alias("layer"), F.col("l_returnflag").alias("version")).agg(
        _n().alias("n_rows"), F.count_if(F.col("l_discount") > 0).alias("mapped"), S.ratio_of(none, _n()).alias("abstention")
    )


@query("""SELECT l_returnflag, l_linestatus, p_type, n_nationkey AS nation, count(DISTINCT l_orderkey) AS subjects FROM lineitem
JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey GROUP BY ALL""")
def mapping_counts_by_meaning(t: Tables):
    rows = t.lineitem.join(t.part, t.lineitem.l_partkey == t.part.p_partkey).join(t.supplier, t.lineitem.l_suppkey == t.supplier.s_suppkey)
    return rows.groupBy("l_returnflag", "l_linestatus", "p_type", F.col("s_nationkey").alias("nation")).agg(
        F.countDistinct("l_orderkey").alias("subjects")
    )


@query("""SELECT l_orderkey AS manifest, l_returnflag AS standard, count(*) AS n, min(l_linenumber) AS first_position FROM lineitem GROUP BY ALL""")
def base_member_rollup(t: Tables):
    rows = t.lineitem.groupBy(F.col("l_orderkey").alias("manifest"), F.col("l_returnflag").alias("standard"))
    return rows.agg(_n().alias("n"), F.min("l_linenumber").alias("first_position"))


@query("SELECT p_brand AS hub, count(DISTINCT p_partkey) AS cards, count(DISTINCT p_type) AS domains, min(p_name) AS label FROM part GROUP BY 1")
def hub_listing(t: Tables):
    return t.part.groupBy(F.col("p_brand").alias("hub")).agg(
        F.countDistinct("p_partkey").alias("cards"), F.countDistinct("p_type").alias("domains"), F.min("p_name").alias("label")
    )


@query("SELECT (SELECT count(*) FROM nation) AS standards, (SELECT count(*) FROM part) AS cards, (SELECT count(*) FROM orders) AS manifests, (SELECT count(DISTINCT l_partkey || '|' || l_suppkey) FROM lineitem) AS mappings")
def root_counts(t: Tables):
    parts = [t.nation.agg(_n().alias("standards")), t.part.agg(_n().alias("cards")), t.orders.agg(_n().alias("manifests"))]
    pairs = t.lineitem.select("l_partkey", "l_suppkey").distinct().agg(_n().alias("mappings"))
    out = pairs
    for one in parts:  # each side is one row
        out = out.join(F.broadcast(one))
    return out.select("standards", "cards", "manifests", "mappings")


@query("""SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')""")
def exists_semi_join(t: Tables):
    urgent = t.orders.where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.join(urgent, "c_custkey", "left_semi").select("c_custkey")


@query("""SELECT c_custkey, (SELECT o_orderpriority FROM orders WHERE o_custkey = c_custkey ORDER BY o_orderkey LIMIT 1) AS first_priority FROM customer""")
def correlated_first_value(t: Tables):
    first = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.min_by("o_orderpriority", "o_orderkey").alias("first_priority"))
    return t.customer.select("c_custkey").join(first, "c_custkey", "left")


@query("""SELECT DISTINCT c_custkey, p_brand FROM customer JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey""")
def three_way_distinct(t: Tables):
    rows = t.orders.join(t.lineitem, t.orders.o_orderkey == t.lineitem.l_orderkey).join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    pairs = rows.select(F.col("o_custkey").alias("c_custkey"), "p_brand").distinct()
    return pairs.join(t.customer.select("c_custkey"), "c_custkey", "left_semi")


@query("""SELECT a.n_nationkey AS element, b.n_nationkey AS sibling FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_nationkey <> b.n_nationkey""")
def element_siblings(t: Tables):
    other = t.nation.select("n_regionkey", F.col("n_nationkey").alias("sibling"))
    pairs = t.nation.join(other, "n_regionkey").where("n_nationkey <> sibling")
    return pairs.select(F.col("n_nationkey").alias("element"), "sibling")


@query("""SELECT o_custkey, count(*) AS n, coalesce(sum(CASE WHEN o_orderstatus = 'F' THEN 1 END), 0)::BIGINT AS mapped,
coalesce(sum(CASE WHEN o_orderstatus = 'P' THEN 1 END), 0)::BIGINT AS abstained FROM orders GROUP BY 1""")
def version_counts_sum(t: Tables):
    return t.orders.groupBy("o_custkey").agg(
        _n().alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("mapped"), F.count_if(F.col("o_orderstatus") == "P").alias("abstained")
    )


@query("""SELECT o_custkey, string_agg(o_orderstatus, '>' ORDER BY o_orderdate, o_orderkey) AS history FROM orders GROUP BY 1""")
def layer_history(t: Tables):
    listed = F.array_sort(F.collect_list(F.struct("o_orderdate", "o_orderkey", "o_orderstatus")))
    text = F.array_join(F.transform(listed, lambda x: x["o_orderstatus"]), ">")
    return t.orders.groupBy("o_custkey").agg(text.alias("history"))


@query("""SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS ordinal FROM lineitem""")
def row_ordinal(t: Tables):
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    return t.lineitem.select("l_orderkey", "l_linenumber", F.row_number().over(order).cast("long").alias("ordinal"))


@query("""SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')""")
def conservation_audit(t: Tables):
    passing = t.orders.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.join(passing, "c_custkey", "left_anti").select("c_custkey")


@query("""SELECT count(DISTINCT l_returnflag) = 1 AS one_model, count(DISTINCT l_returnflag) AS models, count(*) FILTER (WHERE l_returnflag IS NULL) AS without FROM lineitem""")
def embedding_identity_gate(t: Tables):
    models = F.countDistinct("l_returnflag")
    return t.lineitem.agg((models == 1).alias("one_model"), models.alias("models"), F.count_if(F.col("l_returnflag").isNull()).alias("without"))


@query("""SELECT CASE WHEN n = 0 THEN 'none' WHEN debug > 0 THEN 'debug' ELSE 'valid' END AS verdict, kind FROM
(SELECT p_type AS kind, count(*) AS n, count(*) FILTER (WHERE p_size = 50 AND p_brand = 'Brand#1') AS debug FROM part GROUP BY 1)""")
def trust_verdict(t: Tables):
    debug = F.count_if((F.col("p_size") == 50) & (F.col("p_brand") == "Brand#1"))
    rows = t.part.groupBy(F.col("p_type").alias("kind")).agg(_n().alias("n"), debug.alias("debug"))
    return rows.select(bridge.first_match([("none", F.col("n") == 0), ("debug", F.col("debug") > 0)], "valid").alias("verdict"), "kind")


@query("""SELECT event_type, round(sum(user_id / 1e6 * 0.5 + value / 1e6 * 1.5), 8) AS usd FROM events GROUP BY 1""")
def call_pricing(t: Tables):
    usd = S.usd_for(F.col("user_id"), F.col("value"), F.lit(0.5), F.lit(1.5))
    return t.events.groupBy("event_type").agg(F.round(F.sum(usd), 8).alias("usd"))


@query("""SELECT conv_id, count(*) FILTER (WHERE role = 'assistant') AS answers, round(100 * count(*) FILTER (WHERE role = 'assistant') / count(*), 1) AS percent FROM conversations GROUP BY 1""")
def judge_spend_totals(t: Tables):
    own = F.count_if(F.col("role") == "assistant")
    return t.conversations.groupBy("conv_id").agg(own.alias("answers"), S.percent_of(own, _n()).alias("percent"))


@query("""SELECT coalesce(a.k, b.k) AS subject, CASE WHEN a.v IS NULL THEN 'only_candidate' WHEN b.v IS NULL THEN 'only_baseline'
WHEN a.v = b.v THEN 'common' ELSE 'replaced' END AS verdict FROM
(SELECT l_orderkey AS k, max(l_partkey) AS v FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1) a FULL JOIN
(SELECT l_orderkey AS k, max(l_partkey) AS v FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1) b ON a.k = b.k""")
def member_list_compare(t: Tables):
    def of(rows):
        return rows.groupBy(F.col("l_orderkey").alias("subject")).agg(F.max("l_partkey").alias("v"))

    found = compare.compare_records(of(t.lineitem.where("l_returnflag = 'A'")), of(t.lineitem.where("l_linestatus = 'F'")), "subject", ["v"])
    names = {"only_in_a": "only_baseline", "only_in_b": "only_candidate", "changed": "replaced", "same": "common"}
    return found.replace(names, subset=["verdict"])


@query("""SELECT n_regionkey, sum(customers)::BIGINT AS customers, sum(suppliers)::BIGINT AS suppliers FROM (SELECT n_regionkey,
(SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey) AS customers, (SELECT count(*) FROM supplier WHERE s_nationkey = n_nationkey) AS suppliers FROM nation) GROUP BY 1""")
def standard_definition_rollup(t: Tables):
    a = t.customer.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(_n().alias("customers"))
    b = t.supplier.groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(_n().alias("suppliers"))
    rows = t.nation.join(a, "n_nationkey", "left").join(b, "n_nationkey", "left").groupBy("n_regionkey")
    return rows.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("customers", "suppliers")])


@query("""SELECT doc_id, quality, toxic, CASE WHEN quality = 1 AND toxic = 0 THEN 'same' WHEN quality = 0 AND toxic = 1 THEN 'noMatch' ELSE 'best' END AS row_kind FROM labels""")
def rater_rows(t: Tables):
    rules = [("same", (F.col("quality") == 1) & (F.col("toxic") == 0)), ("noMatch", (F.col("quality") == 0) & (F.col("toxic") == 1))]
    return t.labels.select("doc_id", "quality", "toxic", bridge.first_match(rules, "best").alias("row_kind"))


@query("""SELECT o_orderstatus, o_orderpriority, count(*) AS n, round(avg(o_totalprice), 2) AS mean FROM orders GROUP BY ALL""")
def calibration_table(t: Tables):
    return t.orders.groupBy("o_orderstatus", "o_orderpriority").agg(_n().alias("n"), F.round(F.avg("o_totalprice"), 2).alias("mean"))


@query("""SELECT a.o_custkey, a.v AS own, b.v AS other, a.v = b.v AS agrees FROM (SELECT o_custkey, max(o_orderpriority) AS v FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) a
JOIN (SELECT o_custkey, max(o_orderpriority) AS v FROM orders WHERE o_orderstatus = 'O' GROUP BY 1) b ON a.o_custkey = b.o_custkey""")
def version_against_version(t: Tables):
    def of(status, name):
        return t.orders.where(F.col("o_orderstatus") == status).groupBy("o_custkey").agg(F.max("o_orderpriority").alias(name))

    rows = of("F", "own").join(of("O", "other"), "o_custkey")
    return rows.withColumn("agrees", F.col("own") == F.col("other"))
