"""Derived rows step by step and at once, replay counts and reads."""

import json
import random

import pytest
from pyspark.sql import functions as F

from stelae.operators import derived, relations
from stelae.runtime import new_shared_path
from stelae.sources.fold import Store


def _block(name, draw):
    base = name.startswith("b")
    head = {"blockType": "standardBase", "version": "1", "standardKey": "k"} if base else {"blockType": "relationship", "pairA": "s", "pairAVersion": "9", "pairB": "t", "pairBVersion": "2"}
    lines = [head]
    for _ in range(draw.randint(0, 12)):
        if base:
            card = draw.random() < 0.4
            i = f"edc:hub/H/R/q/{draw.randrange(5)}" if card else f"s:{draw.randrange(9)}"
            lines.append({"kind": "node", "stableId": i, "labels": ["HubReference"] if card else [], "ref": {"source": "S"}, "properties": {"definition": [""], "description": ["d é"], "domainId": ["x"]}})
        else:
            kind = draw.choice(["EXACT_MATCH", "OTHER"])
            lines.append({"kind": "edge", "type": kind, "fromRef": {"id": f"s:{draw.randrange(3)}", "source": "S"}, "toRef": {"id": draw.choice(["edc:hub/H/R/q/1", "s:1"]), "source": "H"}, "properties": {"decisionBlockHash": ["z"]}})
    return name, "\n".join(json.dumps(x) for x in lines) + "\n\n"


def _tables(store):
    return {n: sorted(map(str, store.read(n).collect())) for n in (*derived.TABLES, "sources") if store.read(n) is not None}


def test_three_batches_agree_with_a_whole_derivation(spark):
    draw = random.Random(4)
    blocks = [_block(f"{k}{i}", draw) for i in range(7) for k in "br"]
    frame = lambda rows: derived.block_lines(spark.createDataFrame(rows, "ref_id string, text string"))
    step, whole = Store(spark, new_shared_path(spark, "step")), Store(spark, new_shared_path(spark, "whole"))
    assert [derived.update(step, frame(blocks[:n])) for n in (3, 9, 9, 14)] == [1, 2, 2, 3]
    derived.update(whole, frame(blocks))
    assert _tables(step) == _tables(whole)
    assert {r.status for r in derived.verify(step, frame(blocks)).collect()} == {"same"}
    changed = [(b, t.replace("EXACT_MATCH", "CLOSE_MATCH")) for b, t in blocks[:-1]] + [_block("bnew", draw)]
    got = {r.ref_id: r.status for r in derived.verify(step, frame(changed)).collect()}
    assert got["bnew"] == "absent" and got[blocks[-1][0]] == "gone" and got["b0"] == "same"
    told = {b for b, s in got.items() if s == "differs: answer_edges"}
    assert told == {b for b, t in blocks[:-1] if b.startswith("r") and "EXACT_MATCH" in t and any('"EXACT_MATCH"' in x and '"edc:hub/H/R/q/1"' in x for x in t.split("\n"))}


def test_a_failed_update_leaves_the_rows(spark, monkeypatch):
    store = Store(spark, new_shared_path(spark, "step"))
    draw = random.Random(1)
    lines = derived.block_lines(spark.createDataFrame([_block("b1", draw)], "ref_id string, text string"))
    derived.update(store, lines)
    before = _tables(store)
    wrong = derived.block_lines(spark.createDataFrame([_block("b1", draw), ("b2", "{}\nnot json")], "ref_id string, text string"))
    with pytest.raises(Exception, match="not a line of JSON"):
        derived.update(store, wrong)
    assert _tables(store) == before and store.version() == 1 and store.sweep() == 0


def test_digests_tell_bags_apart(spark):
    rows = spark.createDataFrame([("a", 1, None), ("a", 1, None), ("a", 2, "x")], "g string, n long, t string")
    one = derived.digests(rows, "g").collect()
    assert derived.digests(rows.orderBy(F.desc("n")).repartition(3), "g").collect() == one
    for other in ([("a", 1, None), ("a", 2, "x"), ("a", 2, "x")], [("a", 1, ""), ("a", 1, None), ("a", 2, "x")], [("a", 1, None), ("a", 2, "x")]):
        assert derived.digests(spark.createDataFrame(other, rows.schema), "g").collect() != one


def test_replay_merges_by_identity(spark):
    node = lambda i: {"kind": "node", "stableId": i}
    edge = lambda a, b, p=None: {"kind": "edge", "type": "T", "fromRef": {"id": a}, "toRef": {"id": b}, "properties": p}
    text = lambda *x: "\n".join(json.dumps(y) for y in ({}, *x))
    blocks = [("1", text(node("a"), node("b"), edge("a", "b", {"x": ["1"], "y": ["2"]}))), ("2", text(node("b"), edge("a", "b", {"y": ["2"], "x": ["1"]}), edge("a", "b"), edge("b", "c"))), ("3", text())]
    lines = derived.block_lines(spark.createDataFrame(blocks, "ref_id string, text string"))
    members = spark.createDataFrame([("m", "1"), ("m", "2"), ("n", "2"), ("o", "3")], "manifest string, ref_id string")
    got = {r.manifest: (r.blocks, r.nodes, r.edges, r.dangling) for r in derived.replay_counts(members, lines).collect()}
    assert got == {"m": (2, 2, 2, 1), "n": (1, 1, 0, 3), "o": (1, 0, 0, 0)}


def test_pages_outside_the_limits_are_refused():
    for page, size in ((0, 10), (1, 0), (1, 1001)):
        with pytest.raises(ValueError):
            relations.domain_cards(None, None, page, size)


def test_lines_meet_their_headers_where_they_are(spark):
    """Neither sorted nor dealt by block, of which a few may hold nearly all lines; one
    parse a line."""
    rows = [("b", 2, '{"kind":"node","stableId":"y"}'), ("b", 0, '{"blockType":"standardBase","version":"7"}'), ("b", 1, '{"kind":"node","stableId":"x"}'), ("c", 5, '{"blockType":"relationship"}')]
    parsed = derived._parsed(spark.createDataFrame(rows, "ref_id string, number int, line string"))
    plan = parsed._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "SortAggregate" not in plan and plan.count("from_json") == 1
    assert sorted((r.ref_id, r.header.version, r.stableId) for r in parsed.collect()) == [("b", "7", "x"), ("b", "7", "y")]
