"""Nodes and edges minted under a kit's rules, properties as stored, identities of texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from stelae.functions import scalars as S
from stelae.operators import documents, kit
from stelae.plans.model import Tables
from stelae.plans.registry import query

KIT = kit.Kit(
    "CAT", "Catalogue", ("class", "property", "value"), ("HAS_PROPERTY", "REFERENCES"), ("value",), r"^[a-z]:[^\s]+$", ("description",), (("SUPPLIES", "REFERENCES"),), ("OLD_MAPPING",)
)


def _text(column: str):
    return F.col(column).cast("string")


def _nodes(t: Tables):
    size = F.col("p_size")
    rows = t.part.select(
        F.when(size == 50, F.concat(F.lit("p: "), _text("p_partkey"))).when(size == 49, F.lit("p:same")).otherwise(F.concat(F.lit("p:"), _text("p_partkey"))).alias("stable_id"),
        F.when(size > 40, "value").when(size == 1, "stray").otherwise("property").alias("role"), F.when(size == 2, "").when(size != 3, F.col("p_name")).alias("name"),
        F.when(size == 4, "").alias("description"), F.concat(F.lit("c:"), "p_brand").alias("parent"), F.lit("/").alias("path"), F.col("p_type").alias("owner"),
        F.when(size == 5, F.create_map(F.lit("role"), F.array(F.lit("x")))).otherwise(F.create_map(F.lit("size"), F.array(_text("p_size")))).alias("carried"), _text("p_partkey").alias("origin"),
    )
    return kit.mint_nodes(rows, KIT)


NODE_SQL = """WITH n AS (SELECT *, 'p:' || p_partkey AS stable_id, CASE WHEN p_size > 40 THEN 'value' ELSE 'property' END AS role, CASE WHEN p_size <> 3 THEN p_name END AS name
FROM part WHERE p_size NOT IN (1, 2, 5, 50) AND (p_size <> 49 OR (SELECT count(*) FROM part WHERE p_size = 49) = 1))
"""


@query(NODE_SQL + """SELECT stable_id, 'ForgedNode,Catalogue,' || role AS labels, name, CASE role WHEN 'value' THEN NULL ELSE concat_ws(' | ', role, name, p_type) END AS search_text,
p_size::VARCHAR AS size, CASE p_size WHEN 4 THEN '' END AS description FROM n""")
def kit_nodes(t: Tables):
    held = lambda name: F.get(F.col("properties")[name], 0)
    nodes = _nodes(t)[0]
    return nodes.select("stable_id", F.array_join("labels", ",").alias("labels"), held("name").alias("name"), held("searchText").alias("search_text"), held("size").alias("size"), held("description").alias("description"))


@query("""SELECT CASE p_size WHEN 1 THEN 'an unknown role' WHEN 2 THEN 'an empty name' WHEN 5 THEN 'a carried name that is the kit''s' WHEN 50 THEN 'an unclean id' ELSE 'an id minted twice' END AS reason,
count(*) AS n FROM part WHERE p_size IN (1, 2, 5, 50) OR (p_size = 49 AND (SELECT count(*) FROM part WHERE p_size = 49) > 1) GROUP BY 1""")
def kit_refusals(t: Tables):
    return _nodes(t)[1].groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query(NODE_SQL + """, e AS (SELECT l_linenumber, l_returnflag, l_partkey, 'p:' || l_partkey AS to_id FROM lineitem)
SELECT CASE WHEN l_linenumber = 7 THEN 'refused: a retired type' WHEN l_linenumber = 6 THEN 'refused: a type of no registry'
  WHEN to_id IN (SELECT stable_id FROM n) THEN 'REFERENCES ' || CASE l_returnflag WHEN 'R' THEN 'said' ELSE 'structural' END ELSE 'dangling' END AS outcome, count(*) AS n FROM e GROUP BY 1""")
def kit_edges(t: Tables):
    nodes = _nodes(t)[0]
    line = F.col("l_linenumber")
    kind = F.when(line == 7, "OLD_MAPPING").when(line == 6, "MADE_UP").when(line == 5, "REFERENCES").otherwise("SUPPLIES")
    said = F.when(F.col("l_returnflag") == "R", F.create_map(F.lit("provenanceTier"), F.array(F.lit("said"))))
    to = F.concat(F.lit("p:"), _text("l_partkey")).alias("to_id")
    rows = t.lineitem.select(kind.alias("type"), to.alias("from_id"), to, _text("l_orderkey").alias("context"), said.alias("properties"))
    edges, refused, dangling = kit.mint_edges(rows, nodes, KIT)
    made = edges.select(F.concat_ws(" ", "type", F.get(F.col("properties")["provenanceTier"], 0)).alias("outcome"))
    made = made.unionByName(refused.select(F.concat(F.lit("refused: "), "reason").alias("outcome"))).unionByName(dangling.select(F.lit("dangling").alias("outcome")))
    return made.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT p_partkey, '{"name":' || '"' || p_name || '"' || ',"size":' || p_size || ',"tags":["' || p_brand || '"],"two":["a","b"]}' AS stored FROM part""")
def stored_properties(t: Tables):
    """Lists of one are values, but for a declared list; a declared integer is a number."""
    held = F.create_map(F.lit("name"), F.array("p_name"), F.lit("size"), F.array(_text("p_size")), F.lit("tags"), F.array("p_brand"), F.lit("two"), F.array(F.lit("a"), F.lit("b")))
    found = t.part.select("p_partkey", kit.unwrapped(held, ("tags",), ("size",)).alias("m"))
    pairs = F.transform(F.map_entries("m"), lambda e: F.concat(F.lit('"'), e["key"], F.lit('":'), e["value"]))
    return found.select("p_partkey", F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}")).alias("stored"))


@query("""SELECT o_orderkey, sha256(o_orderstatus || chr(10) || o_custkey || chr(10) || 'exact' || chr(10) || o_orderkey || CASE WHEN o_orderpriority = '1-URGENT' THEN chr(10) || 'instance' ELSE '' END) AS match_id FROM orders""")
def match_ids(t: Tables):
    instance = F.when(F.col("o_orderpriority") == "1-URGENT", "instance")
    return t.orders.select("o_orderkey", S.match_id(F.col("o_orderstatus"), _text("o_custkey"), F.lit("exact"), _text("o_orderkey"), instance).alias("match_id"))


@query("""SELECT p_partkey AS doc, '{"a":{"size":' || p_size || ',"type":"' || p_type || '"},"position":' || p_partkey || '}' AS text,
sha256('{"a":{"size":' || p_size || ',"type":"' || p_type || '"}}') AS definition FROM part""")
def frozen_texts(t: Tables):
    """One text however members are ordered, and one digest wherever a definition stands."""
    text = F.concat(F.lit('{ "position" : '), _text("p_partkey"), F.lit(', "a": {"type" :"'), "p_type", F.lit('", "size":'), _text("p_size"), F.lit("}}"))
    docs = t.part.select(F.col("p_partkey").alias("doc"), text.alias("text"))
    return documents.frozen_text(docs).select("doc", "text").join(documents.definition_digests(docs).withColumnRenamed("digest", "definition"), "doc")
