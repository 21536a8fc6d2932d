"""Nested documents: statements, building again, references found by content."""

import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from stelae.operators import documents

KEYS = ["a", "b/c", "d~e", "0", "", "é\"\\", "enum"]


def _value(draw, depth):
    kind = draw.random()
    if depth and kind < 0.35:
        return {k: _value(draw, depth - 1) for k in draw.sample(KEYS, draw.randint(0, 4))}
    if depth and kind < 0.6:
        return [_value(draw, depth - 1) for _ in range(draw.randint(0, 4))]
    return draw.choice([None, True, False, 0, -7, 12345678901, "x", "", "line\nq\"", "☃", 2.5])


def _leaves(value, at="", owner=None):
    if isinstance(value, dict) and value:
        for k, v in value.items():
            yield from _leaves(v, f"{at}/{k.replace('~', '~0').replace('/', '~1')}", k)
    elif isinstance(value, list) and value:
        for i, v in enumerate(value):
            yield from _leaves(v, f"{at}/{'-' if owner == 'enum' else i}")
    else:
        yield at, json.dumps(value, ensure_ascii=False, separators=(",", ":"))


def test_round_trip_over_generated_documents(spark):
    draw = random.Random(5)
    held = {i: _value(draw, 7) for i in range(150)}
    held[200], held[201] = 5, []
    deep = "x"
    for i in range(25):
        deep = {"k": deep} if i % 2 else [deep]
    held[202] = deep
    docs = spark.createDataFrame([(i, json.dumps(v)) for i, v in held.items()] + [(300, None)], "doc long, text string")
    tree = documents.unnest(docs)
    got = Counter((r.doc, r.pointer, r.value) for r in documents.statements(tree, ("enum",)).collect())
    assert got == Counter((i, p, v) for i, d in held.items() for p, v in _leaves(d))
    whole = {r.doc: r.text for r in documents.rebuilt(tree).collect()}
    assert whole == {i: json.dumps(v, sort_keys=True, ensure_ascii=False, separators=(",", ":")) for i, v in held.items()}
    assert tree.depth >= 25


def test_digests_are_equal_for_equal_subtrees_only(spark):
    draw = random.Random(6)
    held = {i: _value(draw, 3) for i in range(80)}
    tree = documents.unnest(spark.createDataFrame([(i, json.dumps(v)) for i, v in held.items()], "doc long, text string"))
    digest = {r.doc: r.value for r in documents.fold_up(tree, digest=True).where("level = 0").collect()}
    text = {i: json.dumps(v, sort_keys=True) for i, v in held.items()}
    for a in held:
        for b in held:
            assert (digest[a] == digest[b]) == (text[a] == text[b])


def test_a_document_that_is_no_json_fails(spark):
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        documents.unnest(spark.createDataFrame([(1, "{")], "doc long, text string"))


def _file(**schemas):
    return json.dumps({"components": {"schemas": schemas}, "paths": {"x": {"copy": schemas.get("A")}}})


def test_references_found_by_content(spark):
    inner = {"type": "object", "title": "B", "properties": {"n": {"type": "integer"}}}
    a = {"title": "A", "properties": {"b": {**inner, "description": "the copy"}, "list": {"items": inner}, "own": {"type": "string"}}}
    c = {"title": "C", "properties": {"a": a, "deep": {"x": {"y": inner}}}}
    near = {"title": "N", "properties": {"b": {**inner, "properties": {"n": {"type": "integer", "description": "inside counts"}}}}}
    docs = [("1", _file(A=a, B={**inner, "description": "whole"}, C=c, N=near)), ("2", _file(A=a, B={**inner, "description": "whole"}))]
    found, refused = documents.recover_references(documents.unnest(spark.createDataFrame(docs, "doc string, text string")))
    got = {(r.component, r.pointer, r.target, r.by_title) for r in found.collect()}
    assert got == {
        ("A", "/properties/b", "B", False), ("A", "/properties/list/items", "B", False),
        ("C", "/properties/a", "A", False), ("C", "/properties/deep/x/y", "B", False),
    }
    assert refused.count() == 0


def test_ambiguous_references_are_refused(spark):
    shape = {"type": "object", "title": "T"}
    docs = [("1", _file(T=shape, U=shape, V={"properties": {"t": shape}})), ("2", _file(W={"properties": {"q": {"type": "object", "title": "Q"}}}, X={"type": "object", "title": "Q"}, Y={"type": "object", "title": "Q"}, T={"type": "array"}))]
    found, refused = documents.recover_references(documents.unnest(spark.createDataFrame(docs, "doc string, text string")))
    assert {(r.name, r.pointer, r.reason.split()[0]) for r in refused.collect()} >= {("T", "", "different"), ("W", "/properties/q", "title")}
    assert all(r.component != "W" for r in found.collect())


def _copies(value, index, at=""):
    """Outermost copies inside a component: pointer, value."""
    for k, v in value.items() if isinstance(value, dict) else enumerate(value) if isinstance(value, list) else ():
        here = f"{at}/{str(k).replace('~', '~0').replace('/', '~1')}"
        if isinstance(v, dict) and v and _bare(v) in index:
            yield here, v
        else:
            yield from _copies(v, index, here)


def _bare(value):
    return json.dumps({k: v for k, v in value.items() if k != "description"}, sort_keys=True)


def test_references_against_plain_search_without_taking_documents_apart(spark, monkeypatch):
    """What equals a component is not cut further, and nothing is folded up again."""
    draw = random.Random(9)
    parts = [{"a": None}, {"description": "only"}, {"a": [], "title": "P2"}, {"a": [], "title": "P2", "description": 1}, {"b/c": {"a": None}, "title": None}, {"'": [[{"a": None}]]}, {"a": 1.5, "b": {"a": [], "title": "P2"}}]
    schemas = {f"P{i}": v for i, v in enumerate(parts)}
    for i in range(40):
        schemas[f"C{i}"] = {k: draw.choice(parts) if draw.random() < 0.6 else [_value(draw, 2), draw.choice(parts)] for k in draw.sample(KEYS, draw.randint(1, 4))}
    schemas |= {"Empty": {}, "List": [1], "Text": "x"}
    docs = [(i, _file(**{k: v for k, v in schemas.items() if draw.random() < 0.5 or i == 3})) for i in range(5)] + [(9, None), (10, "[]"), (11, '{"components":{"schemas":[{}]}}')]
    real = {k: v for k, v in schemas.items() if isinstance(v, dict) and v}
    index = {}
    for name, v in real.items():
        index.setdefault(_bare(v), []).append(name)
    want, tied = set(), set()
    for name, v in real.items():
        for at, copy in _copies(v, index):
            names = index[_bare(copy)]
            title = copy.get("title")
            if len(names) == 1 or title in names:
                want.add((name, at, title if len(names) > 1 else names[0], len(names) > 1))
            else:
                tied.add((name, at))
    monkeypatch.setattr(documents, "fold_up", lambda *a, **b: pytest.fail("folded up"))
    found, refused = documents.recover_references(documents.unnest(spark.createDataFrame(docs, "doc long, text string")))
    assert Counter((r.component, r.pointer, r.target, r.by_title) for r in found.collect()) == Counter(want)
    assert Counter((r.name, r.pointer) for r in refused.collect()) == Counter(tied)
    assert want and any(by for *_, by in want)


def test_files_of_a_small_table_are_made_by_all_cores(spark, small):
    from stelae.plans import document_queries
    from stelae.plans.model import Tables

    assert document_queries._files(Tables(spark, small)).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_refusals_without_taking_documents_apart(spark, small, oracle, monkeypatch):
    from stelae.plans import registry
    from tests.conftest import rows_of

    monkeypatch.setattr(documents, "fold_up", lambda *a, **b: pytest.fail("folded up"))
    got = registry.queries()["dereferenced_refusals"](spark, small).toPandas()
    assert rows_of(got) == rows_of(oracle.execute(registry.oracle_sql()["dereferenced_refusals"]).df())


def test_statements_of_a_graph(spark):
    nodes = spark.createDataFrame([(1, {"a/b": ["x", None], "e": []}), (2, {})], "doc long, properties map<string,array<string>>")
    got = sorted((r.doc, r.pointer, r.value) for r in documents.graph_statements(nodes).collect())
    assert got == [(1, "/a~1b/0", '"x"'), (1, "/a~1b/1", "null"), (1, "/e", "[]")]
    text = spark.createDataFrame([(1, '{"a/b":["x",null],"e":[]}')], "doc long, text string")
    assert sorted((r.doc, r.pointer, r.value) for r in documents.statements(documents.unnest(text)).collect()) == got


def test_pointers_without_order(spark):
    tree = documents.unnest(spark.createDataFrame([(1, '{"enum":[3,1],"x":{"enum":[[2]]}}')], "doc long, text string"))
    got = documents.statements(tree, ("enum",)).agg(F.array_sort(F.collect_list(F.concat_ws(" ", "pointer", "value")))).first()[0]
    assert got == ["/enum/- 1", "/enum/- 3", "/x/enum/-/0 2"]
