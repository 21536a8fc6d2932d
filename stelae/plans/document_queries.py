"""Nested documents made of the driver tables, taken apart and built again."""

from __future__ import annotations

from pyspark.sql import functions as F

from stelae.operators import documents
from stelae.plans.model import Tables
from stelae.plans.registry import query
from stelae.runtime import spread


def _customer_documents(t: Tables):
    """A document for each customer, with orders in a list and a list without order."""
    order = F.struct(F.col("o_orderkey").alias("key"), F.struct(F.col("o_orderstatus").alias("state/now"), F.col("o_orderpriority").alias("rank")).alias("is"))
    held = t.orders.groupBy("o_custkey").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", order.alias("x")))), lambda p: p["x"]).alias("orders"),
        F.array_sort(F.collect_set("o_orderpriority")).alias("enum"),
    )
    whole = t.customer.join(held, F.col("c_custkey") == F.col("o_custkey"), "left")
    text = F.to_json(F.struct(F.col("c_name").alias("name"), F.coalesce("orders", F.array()).alias("orders"), F.coalesce("enum", F.array().cast("array<string>")).alias("enum")))
    return whole.select(F.col("c_custkey").alias("doc"), text.alias("text"))


STATEMENT_SQL = """WITH o AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS i FROM orders JOIN customer ON c_custkey = o_custkey),
s AS (SELECT c_custkey AS doc, '/name' AS pointer, '"' || c_name || '"' AS value FROM customer
UNION ALL SELECT o_custkey, '/orders/' || i || '/key', o_orderkey::VARCHAR FROM o
UNION ALL SELECT o_custkey, '/orders/' || i || '/is/state~1now', '"' || o_orderstatus || '"' FROM o
UNION ALL SELECT o_custkey, '/orders/' || i || '/is/rank', '"' || o_orderpriority || '"' FROM o
UNION ALL SELECT DISTINCT o_custkey, '/enum/-', '"' || o_orderpriority || '"' FROM o
UNION ALL SELECT c_custkey, '/' || unnest(['orders', 'enum']), '[]' FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders))
"""


@query(STATEMENT_SQL + "SELECT * FROM s")
def nested_statements(t: Tables):
    return documents.statements(documents.unnest(_customer_documents(t)), ("enum",))


@query("""WITH o AS (SELECT o_custkey, string_agg('{"is":{"rank":"' || o_orderpriority || '","state/now":"' || o_orderstatus || '"},"key":' || o_orderkey || '}', ',' ORDER BY o_orderkey) AS orders,
  string_agg(DISTINCT '"' || o_orderpriority || '"', ',' ORDER BY '"' || o_orderpriority || '"') AS e FROM orders GROUP BY 1)
SELECT c_custkey AS doc, sha256('{"enum":[' || coalesce(e, '') || '],"name":"' || c_name || '","orders":[' || coalesce(orders, '') || ']}') AS digest
FROM customer LEFT JOIN o ON c_custkey = o_custkey""")
def nested_round_trip(t: Tables):
    """Documents built again from their statements' tree, in canonical JSON."""
    return documents.rebuilt(documents.unnest(_customer_documents(t))).select("doc", F.sha2("text", 256).alias("digest"))


@query("""SELECT 'lost' AS outcome, 2 * count(*) AS n FROM part WHERE p_size > 40
UNION ALL SELECT 'added', count(*) FROM part WHERE p_size > 40 OR p_size <= 10
UNION ALL SELECT 'same', count(*) + count(*) FILTER (WHERE p_size <= 40) + count(*) FILTER (WHERE p_size > 10 AND p_size <= 40) FROM part""")
def graph_statement_loss(t: Tables):
    """What documents of parts state against what the graph's nodes do: in the graph large
    parts lost their kind and changed their brand, and small ones got a mark."""
    large, small = F.col("p_size") > 40, F.col("p_size") <= 10
    source = F.to_json(F.struct(F.array("p_name").alias("name"), F.array("p_type").alias("kind"), F.when(~small, F.array("p_brand")).alias("brand")))
    said = documents.statements(documents.unnest(t.part.select(F.col("p_partkey").alias("doc"), source.alias("text"))))
    entry = lambda key, value: F.struct(F.lit(key).alias("key"), F.array(value).alias("value"))
    brand = F.when(large, "other").otherwise(F.col("p_brand"))
    entries = F.array(entry("name", F.col("p_name")), F.when(~large, entry("kind", F.col("p_type"))), F.when(~small, entry("brand", brand)), F.when(small, entry("a/b", F.lit("x"))))
    values = F.map_from_entries(F.array_compact(entries))
    held = documents.graph_statements(t.part.select(F.col("p_partkey").alias("doc"), values.alias("properties")))
    both = said.withColumn("said", F.lit(1)).join(held.withColumn("held", F.lit(1)), ["doc", "pointer", "value"], "full")
    outcome = F.when(F.col("held").isNull(), "lost").when(F.col("said").isNull(), "added").otherwise("same")
    return both.groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT p_partkey AS doc, '/brand' AS pointer, '"' || p_brand || '"' AS value FROM part UNION ALL SELECT p_partkey, '/kind/0', '"' || p_type || '"' FROM part
UNION ALL SELECT p_partkey, '/kind/1/_unit', '"mm"' FROM part UNION ALL SELECT p_partkey, '/kind/1/size', p_size::VARCHAR FROM part""")
def xml_statements(t: Tables):
    """Locator statements of XML: elements that repeat are lists, attributes have ``_``."""
    text = F.concat(
        F.lit("<part><brand>"), "p_brand", F.lit("</brand><kind>"), "p_type", F.lit('</kind><kind unit="mm"><size>'), F.col("p_size").cast("string"), F.lit("</size></kind></part>")
    )
    rows = t.part.select(F.col("p_partkey").alias("doc"), text.alias("text"))
    return documents.statements(documents.unnest(rows, F.from_xml("text", "variant", {"rowTag": "part"})))


def _files(t: Tables, *kept: str):
    """One file for each customer, with the schemas of region, nation and customer; what
    was a reference is a copy, with a description of its own. kept: columns of customer."""
    region = lambda note: F.struct(
        F.concat(F.lit("Region"), F.col("r_regionkey").cast("string")).alias("title"), F.struct(F.struct(F.lit("string").alias("type"), F.array("r_name").alias("enum")).alias("name")).alias("properties"),
        F.lit(note).alias("description"),
    )
    nation = lambda note: F.struct(
        F.concat(F.lit("Nation"), F.col("n_nationkey").cast("string")).alias("title"),
        F.struct(region("part of it").alias("region"), F.struct(F.lit("string").alias("type"), F.array("n_name").alias("enum")).alias("name")).alias("properties"), F.lit(note).alias("description"),
    )
    customer = F.struct(F.lit("any").alias("title"), F.struct(nation("home").alias("nation"), F.struct(F.col("c_name").alias("const")).alias("name")).alias("properties"))
    rows = spread(t.customer, "c_custkey").join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    # Balances below zero make a second component of equal content, told apart by its title alone.
    named = lambda prefix, key: F.concat(F.lit(prefix), F.col(key).cast("string"))
    schemas = F.map_from_entries(F.array(
        F.struct(named("Region", "r_regionkey"), F.to_json(region("whole"))), F.struct(named("Nation", "n_nationkey"), F.to_json(nation("whole"))),
        F.struct(named("Customer", "c_custkey"), F.to_json(customer)), F.struct(F.when(F.col("c_acctbal") < 0, named("Twin", "n_nationkey")).otherwise("Other"), F.when(F.col("c_acctbal") < 0, F.to_json(nation("twin"))).otherwise("{\"type\":\"null\"}")),
    ))
    body = F.array_join(F.transform(F.map_entries(schemas), lambda e: F.concat(F.lit('"'), e["key"], F.lit('":'), e["value"])), ",")
    return rows.select(F.col("c_custkey").alias("doc"), F.concat(F.lit('{"components":{"schemas":{'), body, F.lit("}}}")).alias("text"), *kept)


@query("""WITH twin AS (SELECT DISTINCT c_nationkey FROM customer WHERE c_acctbal < 0)
SELECT 'Customer' || c_custkey AS component, '/properties/nation' AS pointer, 'Nation' || c_nationkey AS target, c_nationkey IN (FROM twin) AS by_title FROM customer
UNION ALL SELECT DISTINCT 'Nation' || n_nationkey, '/properties/region', 'Region' || n_regionkey, false FROM nation JOIN customer ON c_nationkey = n_nationkey
UNION ALL SELECT 'Twin' || c_nationkey, '/properties/region', 'Region' || n_regionkey, false FROM twin JOIN nation ON n_nationkey = c_nationkey""")
def dereferenced_references(t: Tables):
    return documents.recover_references(documents.unnest(_files(t)))[0]


@query("""SELECT reason, name, pointer FROM (SELECT DISTINCT 'title names none of several equal components' AS reason, 'Customer' || c_custkey AS name, '/properties/nation' AS pointer, c_nationkey FROM customer)
WHERE c_nationkey IN (SELECT c_nationkey FROM customer WHERE c_acctbal < 0)
UNION ALL SELECT DISTINCT 'different components of one name', 'Region' || n_regionkey, '' FROM (SELECT n_regionkey FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY 1 HAVING count(DISTINCT c_mktsegment = 'BUILDING') > 1)""")
def dereferenced_refusals(t: Tables):
    """Titles are taken away, and some files name a region's schema otherwise."""
    files = _files(t, "c_mktsegment")
    bare = F.regexp_replace("text", '"title":"Nation[0-9]+"', '"title":"it"')
    text = F.when(F.col("c_mktsegment") == "BUILDING", F.regexp_replace(bare, r'("Region[0-9]+":\{.*?"description":)"whole"', '$1"another"')).otherwise(bare)
    return documents.recover_references(documents.unnest(files.select("doc", text.alias("text"))))[1]
