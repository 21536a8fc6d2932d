"""Schema sets, cycles, guarded writes, log blocks and URI routes over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from stelae.operators import cycles, routes
from stelae.plans.model import Tables
from stelae.plans.registry import query
from stelae.runtime import new_shared_path, stored
from stelae.sources import edge_writer, log_blocks, rdf, schema_sets


def _text(column: str):
    return F.col(column).cast("string")


# --- schema sets


def _schema_files(t: Tables):
    """A file for each region, which includes its nations' files and imports the next
    region's (a cycle); nations' files have no namespace of their own. Customers are
    elements of a type of their nation; each nation has an element of a type of the next
    region."""
    head = '<xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema"'
    people = F.concat(F.lit('<xs:element name="C'), _text("c_custkey"), F.lit('" type="N'), _text("c_nationkey"), F.lit('"/>'))
    held = t.customer.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.array_join(F.array_sort(F.collect_list(people)), "").alias("people"))
    nations = t.nation.join(held, "n_nationkey", "left")
    body = F.concat(
        F.lit(f'{head}><xs:complexType name="N'), _text("n_nationkey"), F.lit('"><xs:attribute name="a" type="xs:string"/></xs:complexType>'), F.coalesce("people", F.lit("")), F.lit("</xs:schema>")
    )
    files = nations.select(F.concat(F.lit("set/nations/n"), _text("n_nationkey"), F.lit(".xsd")).alias("path"), body.alias("text"))
    last = t.region.agg(F.max("r_regionkey")).first()[0]
    following = F.when(F.col("n_regionkey") == last, 0).otherwise(F.col("n_regionkey") + 1)
    include = F.concat(F.lit('<xs:include schemaLocation="../nations/n'), _text("n_nationkey"), F.lit('.xsd"/>'))
    first = t.nation.groupBy(F.col("n_regionkey").alias("next")).agg(F.min("n_nationkey").alias("first"))
    rows = t.nation.withColumn("next", following.cast(t.nation.schema["n_regionkey"].dataType)).join(first, "next")
    element = F.concat(F.lit('<xs:element name="E'), _text("n_nationkey"), F.lit('" type="nx:N'), _text("first"), F.lit('"/>'))
    region = rows.groupBy("n_regionkey", "next").agg(
        F.array_join(F.array_sort(F.collect_list(include)), "").alias("includes"), F.array_join(F.array_sort(F.collect_list(element)), "").alias("elements")
    )
    whole = F.concat(
        F.lit(f'{head} targetNamespace="urn:r'), _text("n_regionkey"), F.lit('" xmlns:nx="urn:r'), _text("next"), F.lit('">'), "includes",
        F.lit('<xs:import namespace="urn:r'), _text("next"), F.lit('" schemaLocation="./r'), _text("next"), F.lit('.xsd"/>'), "elements", F.lit("</xs:schema>"),
    )
    return files.unionByName(region.select(F.concat(F.lit("set/main/r"), _text("n_regionkey"), F.lit(".xsd")).alias("path"), whole.alias("text")))


def _set(t: Tables):
    rows = schema_sets.read_schemas(_schema_files(t))
    roots = t.spark.createDataFrame([("set/main/r0.xsd",)], "path string")
    return rows, schema_sets.closure(rows, roots)[0]


@query("""SELECT 'set/main/r' || r_regionkey || '.xsd' AS path, 'urn:r' || r_regionkey AS namespace FROM region
UNION ALL SELECT 'set/nations/n' || n_nationkey || '.xsd', 'urn:r' || n_regionkey FROM nation""")
def schema_set_members(t: Tables):
    return _set(t)[1].select("path", "namespace")


@query("""WITH f AS (SELECT n_regionkey, min(n_nationkey) AS first FROM nation GROUP BY 1), last AS (SELECT max(r_regionkey) AS m FROM region)
SELECT 'set/nations/n' || c_nationkey || '.xsd' AS path, 'N' || c_nationkey AS written, 'set/nations/n' || c_nationkey || '.xsd' AS target, count(*) AS uses FROM customer GROUP BY c_nationkey
UNION ALL SELECT 'set/main/r' || n.n_regionkey || '.xsd', 'nx:N' || first, 'set/nations/n' || first || '.xsd', count(*) FROM nation n, last, f
WHERE f.n_regionkey = CASE WHEN n.n_regionkey = m THEN 0 ELSE n.n_regionkey + 1 END GROUP BY ALL""")
def schema_qualified_names(t: Tables):
    rows, members = _set(t)
    found = schema_sets.resolve_names(rows, members).where("found = 1")
    return found.groupBy("path", "written", "target").agg(F.count(F.lit(1)).alias("uses"))


# --- cycles


def _calls(t: Tables):
    """A customer's urgent finished orders point at the customer that their price names."""
    n = t.customer.count()
    rows = t.orders.where("o_orderstatus = 'F' and o_orderpriority = '1-URGENT'")
    return rows.select(F.col("o_custkey").alias("a"), (F.floor("o_totalprice") % n).alias("b"))


CYCLE_SQL = """WITH RECURSIVE e AS (SELECT DISTINCT o_custkey AS a, floor(o_totalprice)::BIGINT % (SELECT count(*) FROM customer) AS b
  FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'),
reach AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM reach r JOIN e ON e.a = r.b),
comp AS (SELECT x.a AS node, least(x.a, min(x.b)) AS component FROM reach x JOIN reach y ON x.a = y.b AND x.b = y.a GROUP BY x.a),
named AS (SELECT node, coalesce(component, node) AS component FROM (SELECT a AS node FROM e UNION SELECT b FROM e) LEFT JOIN comp USING (node)),
ends AS (SELECT DISTINCT p.component AS x, q.component AS y FROM e JOIN named p ON p.node = a JOIN named q ON q.node = b WHERE p.component <> q.component),
deep AS (SELECT DISTINCT component AS x, 0 AS layer FROM named UNION SELECT y, layer + 1 FROM deep JOIN ends USING (x))
"""


@query(CYCLE_SQL + "SELECT node, component FROM comp")
def dependency_cycles(t: Tables):
    return cycles.components(_calls(t))


@query(CYCLE_SQL + "SELECT node, component, max(layer) AS layer FROM named JOIN deep ON x = component GROUP BY ALL")
def dependency_layers(t: Tables):
    return cycles.layers(_calls(t))


# --- the guarded writer

RULES = edge_writer.Rules(("EXACT_MATCH", "CLOSE_MATCH"), ("decision", "price"), ("decision",), "scm", "part")


def _edges(t: Tables):
    kind = F.when(F.col("l_linestatus") == "F", "EXACT_MATCH").otherwise("CLOSE_MATCH")
    held = F.create_map(F.lit("decision"), F.array("l_returnflag"), F.lit("price"), F.array(F.floor("l_extendedprice").cast("string")))
    rows = t.lineitem.select(kind.alias("type"), F.concat(F.lit("s:"), _text("l_suppkey")).alias("from_id"), F.concat(F.lit("p:"), _text("l_partkey")).alias("to_id"), held.alias("properties"))
    suppliers = t.supplier.select(F.concat(F.lit("s:"), _text("s_suppkey")).alias("stable_id"), F.lit("scm").alias("source"), F.array(F.lit("supplier")).alias("labels"))
    parts = t.part.select(F.concat(F.lit("p:"), _text("p_partkey")).alias("stable_id"), F.lit("cat").alias("source"), F.array(F.lit("part")).alias("labels"))
    return rows, suppliers.unionByName(parts)


@query("""SELECT CASE l_linestatus WHEN 'F' THEN 'EXACT_MATCH' ELSE 'CLOSE_MATCH' END AS type, 's:' || l_suppkey AS from_id, count(*) AS n,
sum(floor(l_extendedprice))::BIGINT AS price FROM lineitem GROUP BY ALL""")
def mapping_edges_written(t: Tables):
    """All line items as edges; a second write, which one edge spoils, adds nothing."""
    rows, nodes = _edges(t)
    path = new_shared_path(t.spark, "edges")
    edge_writer.write_edges(rows, nodes, path, RULES)
    spoilt = rows.unionByName(rows.limit(1).withColumn("to_id", F.lit("p:none")))
    try:
        edge_writer.write_edges(spoilt, nodes, path, RULES)
    except Exception as refused:
        if "no node where it ends" not in str(refused):
            raise
    held = edge_writer.read_edges(t.spark, path)
    price = F.sum(F.col("properties")["price"][0].cast("long")).alias("price")
    return held.groupBy("type", "from_id").agg(F.count(F.lit(1)).alias("n"), price)


# --- blocks of a log


@query("""WITH r AS (SELECT l_suppkey, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus FROM lineitem),
m AS (SELECT 'c' || l_suppkey AS name, count(*) AS blocks, count(*) FILTER (WHERE l_returnflag = 'R') AS nominated, count(*) FILTER (WHERE l_linestatus = 'F') AS ranged, round(sum(l_discount), 4) AS cosine FROM r GROUP BY 1)
SELECT * FROM m""")
def candidate_blocks(t: Tables):
    """A log of a block for each line item, read in splits of 64 KB."""
    path = new_shared_path(t.spark, "log")
    lines = F.concat(
        _text("l_linenumber"), F.lit(") c"), _text("l_suppkey"), F.lit(" — retrieval cosine "), _text("l_discount"), F.lit("\n"),
        F.when(F.col("l_returnflag") == "R", "   Nominated by bridge: as returned\n").otherwise(""), F.lit("   some text of it\n"),
        F.when(F.col("l_linestatus") == "F", "   Range: all").otherwise("   nothing more"),
    )
    t.lineitem.select(lines.alias("value")).write.text(path)
    conf, name = t.spark.conf, "spark.sql.files.maxPartitionBytes"
    held = conf.get(name)
    conf.set(name, str(64 << 10))
    try:
        rows = log_blocks.read_lines(t.spark, path)
    finally:
        conf.set(name, held)
    found = log_blocks.candidate_blocks(rows)
    return found.groupBy("name").agg(
        F.count(F.lit(1)).alias("blocks"), F.count_if(F.col("nominated_by") == "bridge").alias("nominated"),
        F.count_if(F.array_contains("markers", "range")).alias("ranged"), F.round(F.sum("cosine"), 4).alias("cosine"),
    )


# --- routes

TEMPLATES = {
    "layer": "layer/{layer}",
    "layerVersion": "layer/{layer}/version/{tag}",
    "manifest": "manifest/{label}",
    "meaning": "hub/{hub}/{release}/q/{key...}",
    "element": "{standard}/{version}/{element...}",
    "block": "sha256/{hash}",
}


@query("""WITH u AS (SELECT event_id, CASE event_id % 9 WHEN 0 THEN 'edc:layer/' || event_type WHEN 1 THEN 'edc:layer/' || event_type || '/version/' || user_id
  WHEN 2 THEN 'edc:hub/H/1/q/' || event_type || '/' || user_id WHEN 3 THEN 'edc:std/' || user_id || '/a%2Fb/' || event_type WHEN 4 THEN 'edc:sha256/' || user_id
  WHEN 5 THEN 'edc:manifest/' || event_type || '?page=2' WHEN 6 THEN 'edc:layer/' || event_type || '?page=2' WHEN 7 THEN 'http://x/' || user_id ELSE 'edc:nothing' END AS uri FROM events),
e AS (SELECT DISTINCT event_type FROM events WHERE event_type <> 'error')
SELECT event_id % 9 AS form, CASE event_id % 9 WHEN 0 THEN 'layer' WHEN 1 THEN 'layerVersion' WHEN 2 THEN 'meaning' WHEN 3 THEN 'element' WHEN 4 THEN 'block' WHEN 5 THEN 'manifest' WHEN 6 THEN 'layer' END AS kind,
  CASE event_id % 9 WHEN 0 THEN CASE WHEN event_type IN (FROM e) THEN 200 ELSE 404 END WHEN 1 THEN 404 WHEN 2 THEN CASE WHEN event_type IN (FROM e) THEN 200 ELSE 404 END
  WHEN 3 THEN CASE WHEN event_type IN (FROM e) THEN 200 ELSE 404 END WHEN 4 THEN 501 WHEN 5 THEN CASE WHEN event_type IN (FROM e) THEN 200 ELSE 404 END ELSE 400 END AS status, count(*) AS n
FROM events GROUP BY ALL""")
def uri_resolution(t: Tables):
    form, kind, user = F.col("event_id") % 9, F.col("event_type"), _text("user_id")
    uri = (
        F.when(form == 0, F.concat(F.lit("edc:layer/"), kind)).when(form == 1, F.concat(F.lit("edc:layer/"), kind, F.lit("/version/"), user))
        .when(form == 2, F.concat(F.lit("edc:hub/H/1/q/"), kind, F.lit("/"), user)).when(form == 3, F.concat(F.lit("edc:std/"), user, F.lit("/a%2Fb/"), kind))
        .when(form == 4, F.concat(F.lit("edc:sha256/"), user)).when(form == 5, F.concat(F.lit("edc:manifest/"), kind, F.lit("?page=2")))
        .when(form == 6, F.concat(F.lit("edc:layer/"), kind, F.lit("?page=2"))).when(form == 7, F.concat(F.lit("http://x/"), user)).otherwise("edc:nothing")
    )
    asked = stored(t.events.groupBy(form.alias("form"), uri.alias("uri")).agg(F.count(F.lit(1)).alias("n")), "uris")
    held = t.events.where("event_type <> 'error'").select("event_type", user.alias("user")).distinct()
    row = lambda kind, *key: F.struct(F.lit(kind).alias("kind"), F.concat(*key).alias("key"))
    keys = F.array(
        row("layer", "event_type"), row("manifest", "event_type"), row("meaning", F.lit("H/1/"), "event_type", F.lit("/"), "user"),
        row("element", F.lit("std/"), "user", F.lit("/a/b/"), "event_type"),
    )
    known = held.select(F.explode(keys).alias("x")).select("x.*").distinct().withColumn("answer", F.col("key"))
    found = routes.matched(asked.select("uri").distinct(), routes.route_table(t.spark, TEMPLATES))
    answers = routes.resolved(found, known, ["layer", "layerVersion", "manifest", "meaning", "element"], ["manifest"])
    return asked.join(answers, "uri").groupBy("form", "kind", "status").agg(F.sum("n").alias("n"))


# --- ontologies


def _ontology_files(t: Tables):
    """A file for each nation: its class, its customers as properties with a range declared
    in place, and their values."""
    names = 'xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:rdfs="http://www.w3.org/2000/01/rdf-schema#" xmlns:skos="http://www.w3.org/2004/02/skos/core#"'
    person = F.concat(
        F.lit('<rdf:Property rdf:about="c:'), _text("c_custkey"), F.lit('" rdfs:label="'), "c_name", F.lit('"><rdfs:domain rdf:resource="n:'), _text("c_nationkey"),
        F.lit('"/><rdfs:range><skos:ConceptScheme rdf:about="s:'), "c_mktsegment", F.lit('"/></rdfs:range></rdf:Property><skos:Concept rdf:about="v:'), _text("c_custkey"),
        F.lit('"><skos:inScheme rdf:resource="s:'), "c_mktsegment", F.lit('"/></skos:Concept>'),
    )
    held = t.customer.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.array_join(F.collect_list(person), "").alias("people"))
    own = F.concat(
        F.lit('<rdfs:Class rdf:about="n:'), _text("n_nationkey"), F.lit('"><rdfs:label xml:lang="de">Land</rdfs:label><rdfs:label xml:lang="en">'), "n_name",
        F.lit('</rdfs:label><rdfs:subClassOf rdf:resource="r:'), _text("n_regionkey"), F.lit('"/></rdfs:Class>'),
    )
    text = F.concat(F.lit(f"<rdf:RDF {names}>"), own, F.coalesce("people", F.lit("")), F.lit("</rdf:RDF>"))
    return t.nation.join(held, "n_nationkey", "left").select(_text("n_nationkey").alias("path"), text.alias("text"))


@query("""SELECT 'n:' || n_nationkey AS id, 'class' AS role, n_name AS label FROM nation UNION ALL SELECT 'c:' || c_custkey, 'property', c_name FROM customer
UNION ALL SELECT DISTINCT 's:' || c_mktsegment, 'optionSet', NULL FROM customer UNION ALL SELECT 'v:' || c_custkey, 'optionValue', NULL FROM customer""")
def ontology_nodes(t: Tables):
    return rdf.ontology(rdf.statements(_ontology_files(t)))[0]


@query("""SELECT 'SUBCLASS_OF' AS type, 'n:' || n_nationkey AS from_id, 'r:' || n_regionkey AS to_id FROM nation UNION ALL SELECT 'HAS_PROPERTY', 'n:' || c_nationkey, 'c:' || c_custkey FROM customer
UNION ALL SELECT 'RANGE', 'c:' || c_custkey, 's:' || c_mktsegment FROM customer UNION ALL SELECT 'HAS_VALUE', 's:' || c_mktsegment, 'v:' || c_custkey FROM customer""")
def ontology_edges(t: Tables):
    return rdf.ontology(rdf.statements(_ontology_files(t)))[1]
