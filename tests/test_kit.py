"""The kit's rules, stored properties, frozen texts."""

import json

import pytest
from pyspark.sql import functions as F

from stelae.operators import documents, kit

KIT = kit.Kit("S", "L", ("class", "value"), ("HAS",), ("value",), r"^s:[^\s]+$", (), (("NATIVE", "HAS"), ("ODD", "NOT")), ("OLD",))
NODE = "stable_id string, role string, name string, description string, parent string, path string, owner string, carried map<string,array<string>>, origin string"


def test_nodes_and_refusals(spark):
    rows = [
        ("s:a", "class", "A", "d", "s:p", "/", None, {"x": ["1", "2"]}, "1"), ("s:b", "value", None, None, None, None, "own", None, "2"), ("s:c", "class", "C", None, None, None, None, None, "3"),
        ("s:c", "class", "C", None, None, None, None, None, "4"), ("s: d", "odd", "", "", None, None, None, {"_id": ["z"]}, "5"), (None, "class", "n", None, None, None, None, None, "6"),
        ("s:e", "class", "n", "d", None, None, None, {"description": ["z"]}, "7"),
    ]
    nodes, refused = kit.mint_nodes(spark.createDataFrame(rows, NODE), KIT)
    got = {r.stable_id: (r.labels, r.properties) for r in nodes.collect()}
    assert got == {
        "s:a": (["ForgedNode", "L", "class"], {"_id": ["s:a"], "_source": ["S"], "name": ["A"], "role": ["class"], "searchText": ["class | A | S"], "parentId": ["s:p"], "path": ["/"], "description": ["d"], "x": ["1", "2"]}),
        "s:b": (["ForgedNode", "L", "value"], {"_id": ["s:b"], "_source": ["S"], "role": ["value"]}),
    }
    assert sorted((r.origin, r.reason) for r in refused.collect()) == [
        ("3", "an id minted twice"), ("4", "an id minted twice"), ("5", "a carried name that is the kit's"), ("5", "an empty description"), ("5", "an empty name"),
        ("5", "an unclean id"), ("5", "an unknown role"), ("6", "an unclean id"), ("7", "a carried name that is the kit's"),
    ]


def test_edges_substituted_refused_and_dangling(spark):
    nodes = spark.createDataFrame([("s:a",), ("s:b",)], "stable_id string")
    rows = [
        ("HAS", "s:a", "s:b", "1", None), ("NATIVE", "s:a", "s:b", "2", {"provenanceTier": ["own"], "k": ["v"]}), ("ODD", "s:a", "s:b", "3", None), ("OLD", "s:a", "s:b", "4", None),
        ("MADE", "s:a", "s:b", "5", None), (None, "s:a", "s:b", "6", None), ("HAS", None, "s:b", "7", None), ("HAS", "s:a", "s:z", "8", None),
    ]
    edges, refused, dangling = kit.mint_edges(spark.createDataFrame(rows, "type string, from_id string, to_id string, context string, properties map<string,array<string>>"), nodes, KIT)
    assert sorted((r.type, sorted(r.properties.items())) for r in edges.collect()) == [("HAS", [("k", ["v"]), ("provenanceTier", ["own"])]), ("HAS", [("provenanceTier", ["structural"])])]
    assert {(r.context, r.reason) for r in refused.collect()} == {("3", "a type of no registry"), ("4", "a retired type"), ("5", "a type of no registry"), ("6", "a type of no registry")}
    assert {r.context for r in dangling.collect()} == {"7", "8"}


def test_properties_as_stored(spark):
    held = {"a": ["x"], "l": ["y"], "n": ["007"], "e": [], "two": ["1", None], "q": ['"']}
    rows = spark.createDataFrame([(held,)], "p map<string,array<string>>")
    assert rows.select(kit.unwrapped(F.col("p"), ("l",), ("n",)).alias("m")).first().m == {"a": '"x"', "l": '["y"]', "n": "7", "e": "[]", "two": '["1",null]', "q": '"\\""'}
    with pytest.raises(Exception, match="no integer in a: x"):
        rows.select(kit.unwrapped(F.col("p"), (), ("a",)).alias("m")).collect()


def test_definitions_without_their_place(spark):
    docs = {1: {"a": [{"position": 1, "t": "x"}], "comments": {"c": 1}}, 2: {"a": [{"t": "x", "position": 7}]}, 3: {"a": [{"t": "y"}]}, 4: {"a": [{"position": 3}]}, 5: {"a": [{}]}, 6: {"position": 1}, 7: {}}
    rows = spark.createDataFrame([(k, json.dumps(v)) for k, v in docs.items()], "doc long, text string")
    found = {r.doc: r.digest for r in documents.definition_digests(rows).collect()}
    assert found[1] == found[2] and found[4] == found[5] and found[6] == found[7] and len(set(found.values())) == 4
    frozen = {r.doc: r.text for r in documents.frozen_text(rows).collect()}
    assert frozen == {k: json.dumps(v, sort_keys=True, separators=(",", ":")) for k, v in docs.items()}
