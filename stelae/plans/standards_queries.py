"""Standards, hubs, resolution rules, gates and ancestry."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from stelae.functions import scalars as S
from stelae.operators import bridge, compare, graph, hub
from stelae.plans.model import Tables
from stelae.plans.registry import query
from stelae.runtime import new_shared_path
from stelae.sources import standards


def _count():
    return F.count(F.lit(1))


def _wrapped(parts, begin: str, end: str):
    """One document of the parts of a (small) published standard."""
    return parts.agg(F.concat(F.lit(begin), F.array_join(F.array_sort(F.collect_list("made")), "\n"), F.lit(end)).alias("value"))


@query("""SELECT 'class' AS role, count(*) AS n FROM region UNION ALL SELECT 'property', count(*) FROM nation
UNION ALL SELECT 'optionValue', 2 * count(*) FROM nation UNION ALL SELECT 'REFERENCES', count(*) FROM nation WHERE n_nationkey % 2 = 0""")
def openapi_walk(t: Tables):
    even = F.col("n_nationkey") % 2 == 0
    ref = F.to_json(F.create_map(F.lit("$ref"), F.concat(F.lit("#/components/schemas/r"), "n_regionkey")))
    body = F.when(even, F.concat(F.lit('{"enum":["a","b"],'), F.substr(ref, F.lit(2)))).otherwise(F.lit('{"enum":["a","b"]}'))
    member = F.concat(F.lit('"n'), F.col("n_nationkey").cast("string"), F.lit('":'), body)
    schema = F.concat(F.lit('"r'), F.col("n_regionkey").cast("string"), F.lit('":{"properties":{'), F.array_join(F.collect_list(member), ","), F.lit("}}"))
    schemas = t.nation.groupBy("n_regionkey").agg(schema.alias("schema"))
    docs = schemas.agg(F.concat(F.lit('{"components":{"schemas":{'), F.array_join(F.collect_list("schema"), ","), F.lit("}}}")).alias("json"))
    nodes, edges = standards.openapi_graph(docs.withColumn("name", F.lit("api")))
    refs = edges.where("type = 'REFERENCES'").groupBy(F.col("type").alias("role")).agg(_count().alias("n"))
    return nodes.groupBy("role").agg(_count().alias("n")).unionByName(refs)


@query("""SELECT 'r' || n_regionkey AS type, 'n' || n_nationkey AS element, 'xs:string' AS element_type,
(row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1)::INTEGER AS ordinal, n_nationkey % 3 = 0 AS optional FROM nation""")
def xsd_walk(t: Tables):
    least = F.when(F.col("n_nationkey") % 3 == 0, F.lit(' minOccurs="0"')).otherwise(F.lit(""))
    element = F.concat(F.lit('<xs:element name="n'), F.col("n_nationkey").cast("string"), F.lit('" type="xs:string"'), least, F.lit("/>"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", element.alias("x")))), lambda e: e["x"])
    made = F.concat(F.lit('<xs:complexType name="r'), F.col("n_regionkey").cast("string"), F.lit('"><xs:sequence>'), F.array_join(listed, ""), F.lit("</xs:sequence></xs:complexType>"))
    path = new_shared_path(t.spark, "xsd")
    types = t.nation.groupBy("n_regionkey").agg(made.alias("made"))
    _wrapped(types, '<xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema">', "</xs:schema>").write.text(path)
    return standards.xsd_elements(t.spark, path)


@query("SELECT 'https://a.example/n' || n_nationkey AS iri, n_name AS label, 'https://a.example/r' || n_regionkey AS parent FROM nation")
def rdf_walk(t: Tables):
    made = F.concat(
        F.lit('<rdfs:Class rdf:about="https://a.example/n'), F.col("n_nationkey").cast("string"), F.lit('"><rdfs:label>'), "n_name",
        F.lit('</rdfs:label><rdfs:subClassOf rdf:resource="https://a.example/r'), F.col("n_regionkey").cast("string"), F.lit('"/></rdfs:Class>'),
    )
    path = new_shared_path(t.spark, "rdf")
    names = 'xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:rdfs="http://www.w3.org/2000/01/rdf-schema#"'
    _wrapped(t.nation.select(made.alias("made")), f"<rdf:RDF {names}>", "</rdf:RDF>").write.text(path)
    return standards.rdf_classes(t.spark, path)


@query("""WITH c AS (SELECT p_name, p_type, p_size, min(p_brand) AS name, count(DISTINCT p_brand) AS n, list(DISTINCT p_brand) AS names FROM part GROUP BY 1, 2, 3)
SELECT p_partkey AS id, CASE WHEN n = 1 THEN name WHEN list_contains(names, 'Brand#' || (p_partkey % 25)) THEN 'Brand#' || (p_partkey % 25) END AS name
FROM part JOIN c USING (p_name, p_type, p_size)""")
def content_digest_reference(t: Tables):
    parts = ["p_name", "p_type", "p_size"]
    shapes = t.part.select(F.col("p_partkey").alias("id"), F.concat(F.lit("Brand#"), F.col("p_partkey") % 25).alias("title"), *parts)
    return standards.digest_references(shapes, t.part.select(F.col("p_brand").alias("name"), *parts), parts)


@query("SELECT l_orderkey AS subject, l_suppkey AS hit, count(*) AS n FROM lineitem GROUP BY ALL")
def freeze_and_expand_votes(t: Tables):
    rows = t.lineitem.select(F.col("l_orderkey").alias("subject"), F.col("l_suppkey").alias("hit"))
    return hub.expand_votes(hub.freeze_votes(rows)).groupBy("subject", "hit").agg(_count().alias("n"))


@query("""SELECT o_custkey % 30 AS bucket, count(*) AS n, count(*) FILTER (WHERE c_custkey IS NULL) AS gaps FROM
(SELECT DISTINCT o_custkey FROM orders) LEFT JOIN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) ON c_custkey = o_custkey GROUP BY 1""")
def subject_leaf_resolution(t: Tables):
    subjects = t.orders.select(F.col("o_custkey").alias("subject"), (F.col("o_custkey") % 10).alias("target_set")).distinct()
    leaves = t.customer.where("c_acctbal > 0").select(F.col("c_custkey").alias("subject"), F.col("c_custkey").alias("leaf"))
    found = hub.resolve_subjects(subjects, leaves)
    return found.groupBy((F.col("subject") % 30).alias("bucket")).agg(_count().alias("n"), F.count_if(F.col("verdict") == "sourceGap").alias("gaps"))


@query("""SELECT o_orderpriority AS leaf, 'collision' AS verdict, count(DISTINCT o_custkey) AS n FROM orders GROUP BY 1 HAVING count(DISTINCT o_custkey % 10) > 1""")
def subject_leaf_collisions(t: Tables):
    subjects = t.orders.select(F.col("o_custkey").alias("subject"), (F.col("o_custkey") % 10).alias("target_set")).distinct()
    leaves = t.orders.select(F.col("o_custkey").alias("subject"), F.col("o_orderpriority").alias("leaf")).distinct()
    found = hub.resolve_subjects(subjects, leaves).where("verdict = 'collision'")
    return found.groupBy("leaf", "verdict").agg(F.countDistinct("subject").alias("n"))


@query("""SELECT p_type AS label, count(DISTINCT l_orderkey) AS units FROM lineitem LEFT JOIN (SELECT p_partkey, CASE WHEN p_size > 5 THEN p_type END AS p_type FROM part) ON p_partkey = l_partkey GROUP BY 1""")
def partition_join(t: Tables):
    labels = t.part.select(F.col("p_partkey").alias("l_partkey"), F.when(F.col("p_size") > 5, F.col("p_type")).alias("label"))
    units = t.lineitem.select("l_orderkey", "l_partkey").join(labels, "l_partkey", "left").groupBy("label")
    return units.agg(F.countDistinct("l_orderkey").alias("units"))


@query("""SELECT p_brand AS card, CASE WHEN p_size > 40 THEN 'VALUE' WHEN p_size > 20 THEN 'RANGE' ELSE 'DOMAIN' END AS slot, count(DISTINCT p_type) AS bases FROM part GROUP BY ALL""")
def card_slot_index(t: Tables):
    size = F.col("p_size")
    slot = bridge.first_match([("VALUE", size > 40), ("RANGE", size > 20)], "DOMAIN").alias("slot")
    return t.part.groupBy(F.col("p_brand").alias("card"), slot).agg(F.countDistinct("p_type").alias("bases"))


@query("""SELECT a.o_orderkey AS from_id, l.l_partkey AS to_id, min(l.l_linenumber) AS locator FROM orders a JOIN lineitem l ON l.l_orderkey = a.o_orderkey
JOIN part ON p_partkey = l_partkey AND p_size > 10 GROUP BY ALL""")
def structural_cross_join(t: Tables):
    refs = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_list(F.struct(F.col("l_partkey").alias("raw"), F.col("l_linenumber").alias("locator"))).alias("cross_refs"))
    records = t.orders.join(refs, "o_orderkey").select(F.col("o_orderkey").alias("id"), "cross_refs")
    universe = t.part.where("p_size > 10").select(F.col("p_partkey").alias("raw"))
    return hub.cross_reference_edges(records, universe)


@query("""SELECT p_partkey, CASE WHEN regexp_matches(p_name, 'ring$') THEN 'ring:' || split_part(p_name, ' ', 1)
WHEN regexp_matches(p_name, '^red') THEN 'red:' || split_part(p_name, ' ', 2) END AS target FROM part""")
def declared_target_rules(t: Tables):
    rules = [(r"^(?=.*ring$)([^ ]*)", "ring:"), (r"^red[^ ]* ([^ ]*)", "red:")]
    return t.part.select("p_partkey", bridge.declared_target(F.col("p_name"), rules).alias("target"))


@query("""SELECT coalesce(j.o_custkey, s.o_custkey) AS unit, j.v IS NULL AS by_subject FROM (SELECT DISTINCT o_custkey FROM orders) r
LEFT JOIN (SELECT o_custkey, max(o_orderkey) AS v FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) j ON j.o_custkey = r.o_custkey
LEFT JOIN (SELECT o_custkey, max(o_orderkey) AS v FROM orders GROUP BY 1) s ON s.o_custkey = r.o_custkey""")
def judge_rater_coalesced(t: Tables):
    def of(rows, name):
        return rows.groupBy(F.col("o_custkey").alias("unit")).agg(F.max("o_orderkey").alias(name))

    rows = of(t.orders, "s").join(of(t.orders.where("o_orderstatus = 'F'"), "j"), "unit", "left")
    return rows.select("unit", F.col("j").isNull().alias("by_subject"))


@query("""SELECT reason, count(*) AS n FROM (SELECT CASE WHEN l_quantity IS NULL THEN 'noSubject' WHEN p.p_partkey IS NULL THEN 'unknownCard'
WHEN s.s_suppkey IS NULL THEN 'unknownElement' WHEN l_discount > 0.09 THEN 'refusedPredicate' ELSE 'accepted' END AS reason FROM lineitem
LEFT JOIN (SELECT p_partkey FROM part WHERE p_size < 45) p ON p.p_partkey = l_partkey
LEFT JOIN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) s ON s.s_suppkey = l_suppkey) GROUP BY 1""")
def import_row_resolution(t: Tables):
    cards = t.part.where("p_size < 45").select(F.col("p_partkey").alias("l_partkey"), F.lit(True).alias("card"))
    elements = t.supplier.where("s_acctbal > 0").select(F.col("s_suppkey").alias("l_suppkey"), F.lit(True).alias("element"))
    rows = t.lineitem.join(cards, "l_partkey", "left").join(elements, "l_suppkey", "left")
    rules = [
        ("noSubject", F.col("l_quantity").isNull()), ("unknownCard", F.col("card").isNull()),
        ("unknownElement", F.col("element").isNull()), ("refusedPredicate", F.col("l_discount") > 0.09),
    ]
    return rows.groupBy(bridge.first_match(rules, "accepted").alias("reason")).agg(_count().alias("n"))


@query("""SELECT DISTINCT c.l_suppkey AS step, p.l_suppkey AS needs FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem WHERE l_linenumber = 1) c
JOIN (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem WHERE l_linenumber = 2) p ON c.l_partkey = p.l_partkey WHERE c.l_suppkey <> p.l_suppkey""")
def producer_consumer_steps(t: Tables):
    def of(line, name):
        return t.lineitem.where(F.col("l_linenumber") == line).select(F.col("l_suppkey").alias(name), "l_partkey").distinct()

    return of(1, "step").join(of(2, "needs"), "l_partkey").where("step <> needs").select("step", "needs").distinct()


@query("SELECT l_orderkey AS id FROM lineitem UNION SELECT l_partkey + 100000000 FROM lineitem")
def unique_endpoints(t: Tables):
    ends = F.explode(F.array(F.col("l_orderkey"), F.col("l_partkey") + 100000000)).alias("id")
    return t.lineitem.select(ends).distinct()


@query("SELECT c_custkey, c_mktsegment FROM customer")
def blinding_projection(t: Tables):
    return t.customer.drop("c_name", "c_acctbal", "c_nationkey")


@query("SELECT vec_id, label FROM embeddings")
def vector_free_projection(t: Tables):
    return t.embeddings.drop("embedding")


@query("""SELECT c_custkey FROM customer WHERE NOT (c_acctbal > 9000 OR c_mktsegment = 'BUILDING' OR c_nationkey IN (1, 2, 3))""")
def retention_predicates(t: Tables):
    keep = (F.col("c_acctbal") > 9000) | (F.col("c_mktsegment") == "BUILDING") | F.col("c_nationkey").isin(1, 2, 3)
    return t.customer.where(~keep).select("c_custkey")


@query("""SELECT role_, count(*) AS violations FROM (SELECT l_returnflag AS role_ FROM lineitem WHERE l_tax = 0 OR l_discount = 0) GROUP BY 1""")
def required_properties(t: Tables):
    return hub.missing_properties(t.lineitem.select(F.col("l_returnflag").alias("role_"), F.nullif("l_tax", F.lit(0.0)).alias("a"), F.nullif("l_discount", F.lit(0.0)).alias("b")), "role_", ["a", "b"])


@query("SELECT o_orderkey FROM orders WHERE (o_orderstatus = 'F') = (o_totalprice > 250000)")
def source_xor_meta(t: Tables):
    return t.orders.where((F.col("o_orderstatus") == "F") == (F.col("o_totalprice") > 250000)).select("o_orderkey")


@query("""SELECT p_brand, string_agg(CASE WHEN r <= 6 THEN p_partkey::VARCHAR END, ',' ORDER BY p_partkey) || CASE WHEN max(r) > 6 THEN ' +' || (max(r) - 6) || ' more' ELSE '' END AS sample
FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS r FROM part) GROUP BY 1""")
def capped_text(t: Tables):
    return hub.capped_lists(t.part, "p_brand", "p_partkey", 6)


@query("""WITH RECURSIVE a AS (SELECT p_partkey AS start, p_partkey AS cur, 0 AS steps FROM part UNION ALL
SELECT start, floor(cur / 2)::BIGINT, steps + 1 FROM a WHERE cur > 0) SELECT start, max(steps)::INTEGER AS depth FROM a GROUP BY 1""")
def recipe_ancestry(t: Tables):
    parents = t.part.select(F.col("p_partkey").alias("id"), F.when(F.col("p_partkey") > 0, F.floor(F.col("p_partkey") / 2)).alias("parent"))
    return hub.chain_depths(parents).select(F.col("id").alias("start"), "depth")


@query("""SELECT p_partkey, sha256('{"brand":"' || p_brand || '","size":' || p_size || ',"type":"' || p_type || '"}') AS digest FROM part""")
def canonical_json(t: Tables):
    text = F.to_json(F.struct(F.col("p_brand").alias("brand"), F.col("p_size").alias("size"), F.col("p_type").alias("type")))
    return t.part.select("p_partkey", F.sha2(text, 256).alias("digest"))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'P' || lpad(p_partkey::VARCHAR, 6, '0') WHEN p_partkey % 3 = 1 THEN split_part('https://x.example/v#' || p_name, '#', 2) ELSE p_name END AS key FROM part""")
def key_transforms(t: Tables):
    kind, six = F.col("p_partkey") % 3, F.lpad(F.col("p_partkey").cast("string"), 6, "0")
    uri = F.concat(F.lit("https://x.example/v#"), "p_name")
    key = F.when(kind == 0, F.concat(F.lit("P"), six)).when(kind == 1, F.element_at(F.split(uri, "#"), 2)).otherwise(F.col("p_name"))
    return t.part.select("p_partkey", key.alias("key"))


@query("""SELECT p_partkey, 'https://e.example/card/' || replace(p_name, ' ', '%20') AS uri, p_name AS name FROM part""")
def uri_mint_and_parse(t: Tables):
    uri = F.concat(F.lit("https://e.example/card/"), S.encode_segment(F.col("p_name")))
    rows = t.part.select("p_partkey", uri.alias("uri"))
    return rows.withColumn("name", F.url_decode(F.regexp_extract("uri", "^https://e.example/card/([^/]+)$", 1)))


@query("""SELECT vec_id, len(embedding)::INTEGER AS width, embedding[1]::FLOAT::DOUBLE AS first, embedding[len(embedding)]::FLOAT::DOUBLE AS last,
list_max(list_transform(embedding, lambda x: x::FLOAT))::DOUBLE AS most FROM embeddings""")
def vector_encode_decode(t: Tables):
    rows = hub.decoded_vectors(hub.encoded_vectors(t.embeddings.select("vec_id", "embedding")))
    value = lambda c: c.cast("double")
    first, last = value(F.get("vector", 0)), value(F.get("vector", F.size("vector") - 1))
    return rows.select("vec_id", "width", first.alias("first"), last.alias("last"), value(F.array_max("vector")).alias("most"))


@query("""SELECT user_id, string_agg(event_type || '=' || n, ',' ORDER BY event_type) AS totals FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL) GROUP BY 1""")
def map_merge_sum(t: Tables):
    counts = t.events.groupBy("user_id", F.to_date("ts").alias("day"), "event_type").agg(_count().alias("n"))
    maps = counts.groupBy("user_id", "day").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "n"))).alias("m"))
    merged = maps.groupBy("user_id").agg(hub.merged_sums(F.collect_list("m")).alias("m"))
    text = F.transform(F.map_entries("m"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return merged.select("user_id", F.array_join(F.array_sort(text), ",").alias("totals"))


@query("""SELECT l_returnflag AS tier, l_linestatus AS kind, count(*) AS n, count(DISTINCT l_suppkey) AS sources FROM lineitem GROUP BY ALL""")
def meaning_tier_census(t: Tables):
    rows = t.lineitem.groupBy(F.col("l_returnflag").alias("tier"), F.col("l_linestatus").alias("kind"))
    return rows.agg(_count().alias("n"), F.countDistinct("l_suppkey").alias("sources"))


@query("""SELECT lang, count(*) AS nodes, count(*) FILTER (WHERE length(text) > 0) AS with_text, count(*) FILTER (WHERE n_chars > 1000) AS searched FROM documents GROUP BY 1""")
def text_field_coverage(t: Tables):
    return t.documents.groupBy("lang").agg(
        _count().alias("nodes"), F.count_if(F.length("text") > 0).alias("with_text"), F.count_if(F.col("n_chars") > 1000).alias("searched")
    )


@query("""SELECT o_orderkey FROM orders JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey WHERE n <> 4""")
def declared_degree_check(t: Tables):
    held = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(_count().alias("n"))
    return t.orders.select("o_orderkey").join(held, "o_orderkey").where("n <> 4").select("o_orderkey")


@query("""SELECT count(*) AS sets, count(*) FILTER (WHERE c_custkey IS NULL) AS empty FROM nation LEFT JOIN (SELECT c_nationkey, min(c_custkey) AS c_custkey FROM customer WHERE c_acctbal > 9900 GROUP BY 1) ON c_nationkey = n_nationkey""")
def option_set_counts(t: Tables):
    held = t.customer.where("c_acctbal > 9900").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.min("c_custkey").alias("one"))
    rows = t.nation.join(held, "n_nationkey", "left")
    return rows.agg(_count().alias("sets"), F.count_if(F.col("one").isNull()).alias("empty"))


@query("""SELECT p_partkey AS id, count(*) AS n FROM (SELECT p_partkey FROM part UNION ALL SELECT l_partkey FROM lineitem WHERE l_linenumber = 7) GROUP BY 1 HAVING count(*) > 1""")
def duplicate_id_refusal(t: Tables):
    again = t.lineitem.where("l_linenumber = 7").select(F.col("l_partkey").alias("id"))
    ids = t.part.select(F.col("p_partkey").alias("id")).unionByName(again)
    return ids.groupBy("id").agg(_count().alias("n")).where("n > 1")


@query("""SELECT 'l_returnflag' AS dimension, v AS lost FROM (SELECT DISTINCT l_returnflag AS v FROM lineitem WHERE l_linestatus = 'F') WHERE v NOT IN (SELECT l_returnflag FROM lineitem WHERE l_linestatus = 'O')
UNION ALL SELECT 'l_partkey', v::VARCHAR FROM (SELECT DISTINCT l_partkey AS v FROM lineitem WHERE l_quantity = 1) WHERE v NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity = 50)""")
def inventory_regression(t: Tables):
    def lost(dimension, before, after):
        keys = [x.select(F.col(dimension).cast("string").alias("lost")) for x in (before, after)]
        return compare.diff_sets(*keys, "lost").where("side = 'missing'").select(F.lit(dimension).alias("dimension"), "lost")

    rows = t.lineitem
    first = lost("l_returnflag", rows.where("l_linestatus = 'F'"), rows.where("l_linestatus = 'O'"))
    return first.unionByName(lost("l_partkey", rows.where("l_quantity = 1"), rows.where("l_quantity = 50")))


@query("""SELECT source, facet, n_name AS hub FROM (VALUES ('a', 'x'), ('a', 'y'), ('b', 'x')) d(source, facet), nation WHERE n_regionkey = CASE WHEN source = 'a' THEN 1 ELSE 2 END""")
def bridge_expansion(t: Tables):
    declared = t.spark.createDataFrame([("a", "x", 1), ("a", "y", 1), ("b", "x", 2)], "source string, facet string, n_regionkey int")
    return t.nation.join(F.broadcast(declared), "n_regionkey").select("source", "facet", F.col("n_name").alias("hub"))


@query("""SELECT o_custkey, max(o_orderdate) AS latest, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS status FROM orders GROUP BY 1 HAVING count(*) FILTER (WHERE o_orderstatus = 'F') > 0""")
def current_standard_version(t: Tables):
    last = F.max(F.struct("o_orderdate", "o_orderkey", "o_orderstatus"))
    rows = t.orders.groupBy("o_custkey").agg(last.alias("x"), F.count_if(F.col("o_orderstatus") == "F").alias("n"))
    return rows.where("n > 0").select("o_custkey", F.col("x.o_orderdate").alias("latest"), F.col("x.o_orderstatus").alias("status"))


@query("""SELECT c_custkey, coalesce(last, 'initial') AS status FROM customer LEFT JOIN
(SELECT o_custkey, arg_max(o_orderstatus, o_orderkey) AS last FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1) ON o_custkey = c_custkey""")
def effective_layer_status(t: Tables):
    changes = t.orders.where("o_orderpriority = '1-URGENT'").groupBy(F.col("o_custkey").alias("c_custkey"))
    last = changes.agg(F.max_by("o_orderstatus", "o_orderkey").alias("last"))
    return t.customer.join(last, "c_custkey", "left").select("c_custkey", F.coalesce("last", F.lit("initial")).alias("status"))


@query("""SELECT p_partkey, rank() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS place FROM part""")
def pool_rerank(t: Tables):
    order = Window.partitionBy("p_brand").orderBy(F.desc("p_retailprice"), "p_partkey")
    return t.part.select("p_partkey", F.rank().over(order).cast("long").alias("place"))


@query("""SELECT count(*) AS nodes, count(DISTINCT n_name) AS names, (SELECT count(*) FROM customer) AS edges,
(SELECT count(DISTINCT c_nationkey || '>' || c_custkey) FROM customer) AS identities FROM nation""")
def conservation_summary(t: Tables):
    a = t.nation.agg(_count().alias("nodes"), F.countDistinct("n_name").alias("names"))
    b = t.customer.agg(_count().alias("edges"), F.countDistinct(F.concat_ws(">", "c_nationkey", "c_custkey")).alias("identities"))
    return a.join(F.broadcast(b))  # one row each


@query("""SELECT n_regionkey, 2 AS depth, count(*) AS n FROM nation GROUP BY 1""")
def path_guarded_reachability(t: Tables):
    edges = t.nation.select(F.concat(F.lit("r"), "n_regionkey").alias("from_id"), F.concat(F.lit("n"), "n_nationkey").alias("to_id"))
    back = edges.select(F.col("to_id").alias("from_id"), F.col("from_id").alias("to_id"))
    roots = t.region.select(F.concat(F.lit("r"), "r_regionkey").alias("stable_id"))
    paths = hub.guarded_paths(edges.unionByName(back), roots, 3)
    found = paths.where(F.size("path") == 2).groupBy(F.substr(F.col("path")[0], F.lit(2)).cast("int").alias("n_regionkey"))
    return found.agg(F.lit(2).alias("depth"), _count().alias("n"))
