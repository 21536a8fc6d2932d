"""Sources and sinks, each written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from stelae.functions import scalars as S
from stelae.operators import bridge
from stelae.plans.model import GRAPH_SQL, Tables, edges, nodes
from stelae.plans.registry import query
from stelae.runtime import new_shared_path
from stelae.sources import blocks, stores, tables
from stelae.streaming import event_log


@query(GRAPH_SQL + "SELECT 'node' AS kind, stable_id AS id, name AS info FROM nodes UNION ALL SELECT 'edge', from_id || '>' || to_id, type FROM edges")
def block_round_trip(t: Tables):
    path = new_shared_path(t.spark, "block")
    ref = lambda c: F.struct(F.lit("model").alias("source"), F.col(c).alias("id"))
    written = nodes(t).select(
        ref("stable_id").alias("ref"), F.array("source", "role").alias("labels"), F.col("stable_id").alias("stableId"),
        F.create_map(F.lit("name"), F.array("name")).alias("properties"),
    )
    links = edges(t).select("type", ref("from_id").alias("fromRef"), ref("to_id").alias("toRef"))
    header = t.spark.range(1).select(F.lit("standardBase").alias("blockType"), F.lit(1).alias("serializerVersion"))
    blocks.write_block(header, written, links, path)
    n, e = blocks.read_block(t.spark, path)
    a = n.select(F.lit("node").alias("kind"), F.col("stableId").alias("id"), F.col("properties")["name"][0].alias("info"))
    return a.unionByName(
        e.select(F.lit("edge").alias("kind"), F.concat("fromRef.id", F.lit(">"), "toRef.id").alias("id"), F.col("type").alias("info"))
    )


@query("SELECT event_id, event_type, value FROM events")
def log_round_trip(t: Tables):
    path = new_shared_path(t.spark, "log")
    t.events.select("event_id", "event_type", "value").write.json(path)
    return blocks.read_log(t.spark, path, "event_id bigint, event_type string, value double")


@query("SELECT p_partkey::VARCHAR AS subject_id, p_brand AS object_id, p_type AS predicate_id FROM part")
def sssom_round_trip(t: Tables):
    path = new_shared_path(t.spark, "sssom")
    rows = t.part.select(F.col("p_partkey").alias("subject_id"), F.regexp_replace("p_brand", "#", "%23").alias("object_id"), F.col("p_type").alias("predicate_id"))
    tables.write_tsv(rows, path)
    _, found = tables.read_sssom(t.spark, path)
    return found.withColumn("object_id", F.regexp_replace("object_id", "%23", "#"))


@query("SELECT p_partkey, CASE WHEN p_size > 25 THEN 'https://a.example/' ELSE 'https://b.example/' END || p_partkey AS iri FROM part")
def curie_expansion(t: Tables):
    curie = F.concat(F.when(F.col("p_size") > 25, "a:").otherwise("b:"), F.col("p_partkey").cast("string")).alias("curie")
    prefixes = t.spark.createDataFrame([("a", "https://a.example/"), ("b", "https://b.example/")], "prefix string, base string")
    return tables.expand_curies(t.part.select("p_partkey", curie), "curie", prefixes).select("p_partkey", "iri")


@query("SELECT page_id, regexp_extract(html, '<title>(.*?)</title>', 1, 's') AS title FROM pages")
def xml_title_extract(t: Tables):
    return t.pages.select("page_id", tables.html_title(F.col("html")).alias("title"))


@query("SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def json_property_path(t: Tables):
    return t.events.select("event_id", F.get_json_object("props", "$.k").alias("k"))


@query("SELECT n_nationkey::VARCHAR AS subject, 'name' AS predicate, n_name AS object FROM nation UNION ALL SELECT n_nationkey::VARCHAR, 'region', n_regionkey::VARCHAR FROM nation")
def json_ld_statements(t: Tables):
    entry = F.create_map(F.lit("@id"), F.col("n_nationkey").cast("string"), F.lit("name"), "n_name", F.lit("region"), F.col("n_regionkey").cast("string"))
    docs = t.nation.groupBy(F.col("n_regionkey").alias("name")).agg(F.to_json(F.struct(F.collect_list(entry).alias("@graph"))).alias("json"))
    return tables.json_ld_statements(docs).select("subject", "predicate", "object")


@query("SELECT n_nationkey, n_name AS label, n_regionkey::VARCHAR AS region FROM nation")
def xml_values(t: Tables):
    xml = F.concat(F.lit("<class><label>"), "n_name", F.lit("</label><region>"), F.col("n_regionkey").cast("string"), F.lit("</region></class>"))
    rows = t.nation.select("n_nationkey", xml.alias("xml"))
    return tables.xml_values(rows, "xml", {"label": "/class/label", "region": "/class/region"}).drop("xml")


@query("""SELECT sha256(event_type || '|' || user_id) AS id, min(event_id) AS content FROM events
GROUP BY 1 HAVING count(DISTINCT event_id) > 1 AND min(event_id) <> max(CASE WHEN event_type = 'click' THEN event_id ELSE -1 END)
AND max(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) = 1""")
def content_address_conflicts(t: Tables):
    address = F.sha2(F.concat_ws("|", "event_type", F.col("user_id").cast("string")), 256).alias("id")
    rows = t.events.where("event_type = 'click'").select(address, F.col("event_id").alias("content"))
    held = rows.groupBy("id").agg(F.max("content").alias("content"))
    return blocks.put_once(held, rows, "id", "content")[1]


@query("""SELECT event_type, date_trunc('hour', ts) AS hour, count(*) AS n, round(sum(value), 4) AS usd FROM events GROUP BY ALL""")
def event_log_stream(t: Tables):
    return event_log.hourly_totals(t.spark, f"{t.sf_dir}/events.parquet", t.events.schema)


@query("SELECT event_id, value FROM events WHERE event_type = 'click'")
def trail_discovery(t: Tables):
    path = new_shared_path(t.spark, "trails")
    t.events.select("event_id", "value", "event_type").write.partitionBy("event_type").json(path)
    found = t.spark.read.schema("event_id bigint, value double, event_type string").json(path)
    return found.where("event_type = 'click'").select("event_id", "value")


@query("SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS priority FROM orders")
def json_to_tsv(t: Tables):
    path = new_shared_path(t.spark, "tsv")
    priority = F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority"))
    lines = t.orders.select(F.to_json(F.struct("o_orderkey", "o_orderstatus", priority.alias("priority"))).alias("value"))
    tables.write_tsv(tables.union_of_keys(lines), path)
    return t.spark.read.csv(path, sep="\t", header=True, schema="o_orderkey bigint, o_orderstatus string, priority string")


@query("SELECT p_partkey AS object, p_brand AS label FROM part")
def partition_file_read(t: Tables):
    path = new_shared_path(t.spark, "partition")
    tables.write_tsv(t.part.select(F.col("p_partkey").alias("object"), F.col("p_brand").alias("label")), path)
    return tables.read_partition(t.spark, path, "object bigint, label string")


@query("""SELECT n_regionkey, sha256(string_agg('{"kind":"node","id":"' || n_nationkey || '","name":"' || n_name || '"}', chr(10) ORDER BY n_nationkey) || chr(10)) AS digest FROM nation GROUP BY 1""")
def block_serialize(t: Tables):
    line = F.to_json(F.struct(F.lit("node").alias("kind"), F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("name")))
    listed = F.array_sort(F.collect_list(F.struct("n_nationkey", line.alias("line"))))
    text = F.concat(F.array_join(F.transform(listed, lambda x: x["line"]), "\n"), F.lit("\n"))
    return t.nation.groupBy("n_regionkey").agg(F.sha2(text, 256).alias("digest"))


@query("SELECT DISTINCT sha256('m1' || chr(0) || '64' || chr(0) || p_name) AS id, p_name AS text FROM part WHERE p_name NOT IN (SELECT p_name FROM part WHERE p_size = 50)")
def vector_put(t: Tables):
    address = F.sha2(F.concat_ws("\u0000", F.lit("m1"), F.lit("64"), "p_name"), 256).alias("id")
    rows = t.part.select(address, F.col("p_name").alias("text"), "p_size")
    held = rows.where("p_size = 50").select("id", "text").distinct()
    return blocks.put_once(held, rows.select("id", "text"), "id", "text")[0]


@query("""WITH c AS (SELECT sha256(event_type || '|' || user_id) AS id, event_id AS content, ts FROM events),
f AS (SELECT id, arg_min(content, (ts, content)) AS held FROM c GROUP BY 1)
SELECT id, content FROM c JOIN f USING (id) WHERE content <> held""")
def content_conflicts_in_order(t: Tables):
    """Every content of an address after its first, in the order of writing, is refused."""
    address = F.sha2(F.concat_ws("|", "event_type", F.col("user_id").cast("string")), 256).alias("id")
    rows = t.events.select(address, F.col("event_id").alias("content"), F.struct("ts", "event_id").alias("at"))
    return blocks.put_once(rows.select("id", "content").where("false"), rows, "id", "content", "at")[1]


@query("""WITH c AS (SELECT p_name AS id, p_partkey AS content FROM part), h AS (SELECT p_name AS id, min(p_partkey) AS content FROM part WHERE p_size = 50 GROUP BY 1)
SELECT id, min(content) AS content FROM c WHERE id NOT IN (SELECT id FROM h) GROUP BY 1""")
def block_save_in_order(t: Tables):
    """What a store takes of a batch whose addresses have several contents: the first."""
    rows = t.part.select(F.col("p_name").alias("id"), F.col("p_partkey").alias("content"), F.col("p_partkey").alias("at"), "p_size")
    held = rows.where("p_size = 50").groupBy("id").agg(F.min("content").alias("content"))
    return blocks.put_once(held, rows.drop("p_size"), "id", "content", "at")[0]


@query("SELECT p_partkey, sha256('m1' || chr(0) || '64' || chr(0) || p_name) AS id FROM part")
def vector_get_verified(t: Tables):
    path = new_shared_path(t.spark, "vectors")
    address = S.vector_id(F.lit("m1"), F.lit(64), F.col("p_name"))
    t.part.select("p_partkey", "p_name", address.alias("id")).write.parquet(path)
    return stores.verified(t.spark.read.parquet(path), "id", address).select("p_partkey", "id")


@query("""WITH s AS (SELECT l_suppkey AS pair, l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_returnflag = 'N', l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice) AS seq FROM lineitem)
SELECT pair, max(seq) AS seq, arg_max(l_orderkey, seq) AS block FROM s GROUP BY 1""")
def decision_block_latest(t: Tables):
    rows = t.lineitem.select(F.col("l_suppkey").alias("pair"), "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_returnflag")
    empty = rows.limit(0).drop("l_returnflag").withColumn("seq", F.lit(0))
    store = stores.append_numbered(empty, rows.where("l_returnflag <> 'N'").drop("l_returnflag"), "pair")
    store = stores.append_numbered(store, rows.where("l_returnflag = 'N'").drop("l_returnflag"), "pair")
    return bridge.latest(store, "pair", "seq").select("pair", F.col("seq").cast("bigint").alias("seq"), F.col("l_orderkey").alias("block"))


@query("SELECT user_id, event_type, min(event_id) AS event_id, arg_min(value, event_id) AS value FROM events GROUP BY ALL")
def judgment_cache_put(t: Tables):
    return stores.first_written(t.events, ["user_id", "event_type"], "event_id").select("user_id", "event_type", "event_id", "value")


@query("""SELECT c_custkey, c_mktsegment AS segment, CASE WHEN o.n IS NOT NULL THEN -1 ELSE c_nationkey END AS nation, o.n AS orders FROM customer
LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) o ON o_custkey = c_custkey""")
def save_object_evolution(t: Tables):
    store = t.customer.select("c_custkey", F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation"))
    new = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.lit(-1).alias("nation"), F.count(F.lit(1)).alias("orders"))
    new = new.join(t.customer.select("c_custkey"), "c_custkey", "left_semi")
    return stores.save_objects(store, new, "c_custkey")


@query("""SELECT 0::BIGINT AS n, '# mapping_set_id: parts' AS value UNION ALL SELECT 1, '# predicate_id: exact' UNION ALL
SELECT 2, 'subject_id' || chr(9) || 'object_id' UNION ALL SELECT 3, p_partkey || chr(9) || p_brand FROM part""")
def sssom_export(t: Tables):
    rows = t.part.select(F.col("p_partkey").alias("subject_id"), F.lit("exact").alias("predicate_id"), F.col("p_brand").alias("object_id"))
    return stores.sssom_lines(rows, {"mapping_set_id": "parts"}, ["subject_id", "predicate_id", "object_id"])
