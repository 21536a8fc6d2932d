"""Operators on hand-made rows."""

import random

import pytest
from pyspark.sql import functions as F

from stelae.functions import scalars as S
from stelae.operators import bridge, compare, graph, retrieval
from stelae.sources import blocks


def test_reach_ends_on_a_cycle(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("x", "y")], "from_id string, to_id string")
    roots = spark.createDataFrame([("a",)], "stable_id string")
    got = {(r.stable_id, r.depth) for r in graph.reach(edges, roots).collect()}
    assert got == {("a", 0), ("b", 1), ("c", 2)}


def test_upsert_keeps_earlier_values_under_null(spark):
    rows = spark.createDataFrame([("n", 1, "a", "x"), ("n", 2, "b", None)], "id string, at int, p string, q string")
    assert [tuple(r) for r in graph.upsert(rows, "id", "at", ["p", "q"]).collect()] == [("n", "b", "x")]


def test_resolve_marks_dangling_edges(spark):
    nodes = spark.createDataFrame([("a",), ("b",)], "stable_id string")
    edges = spark.createDataFrame([("t", "a", "b"), ("t", "a", "z")], "type string, from_id string, to_id string")
    assert {(r.to_id, r.resolved) for r in graph.resolve(edges, nodes).collect()} == {("b", True), ("z", False)}


def test_cosine_ties_go_to_the_smaller_id(spark):
    rows = spark.createDataFrame([(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.0]), (4, [0.0, 0.0])], "id long, vector array<double>")
    got = retrieval.cosine_top_k(rows.where("id = 1"), rows, 2, 0.5, skip_own=True).collect()
    assert {(r.card, r["rank"], round(r.cosine, 9)) for r in got} == {(2, 1, 1.0), (3, 2, 1.0)}
    with pytest.raises(ValueError):
        retrieval.cosine_top_k(rows, rows, 0, 0.5)


def test_silent_neighbours_stay_in_the_denominator(spark):
    near = spark.createDataFrame([("s", "a"), ("s", "b"), ("s", "c"), ("s", "d")], "subject string, neighbour string")
    named = spark.createDataFrame([("a", "K")], "neighbour string, class string")
    assert retrieval.class_shares(near, named).first()["share"] == 0.25


def test_vote_needs_a_property_path(spark):
    hits = spark.createDataFrame([("s", "t1", "b1", 0.9), ("s", "t1", "b2", 0.8), ("s", "t2", "b3", 0.7)], "subject string, text string, base string, cosine double")
    slots = spark.createDataFrame([("c1", "PROPERTY", "b1"), ("c1", "PROPERTY", "b2"), ("c2", "RANGE", "b3")], "card string, slot string, base string")
    got = retrieval.vote_pool(hits, slots).collect()
    assert [(r.card, r.own_votes, r.paths) for r in got] == [("c1", 1, 2)]


def test_bags_and_records(spark):
    a = spark.createDataFrame([("x",), ("x",), ("y",)], "k string")
    b = spark.createDataFrame([("x",)], "k string")
    assert {tuple(r) for r in compare.bag_surplus(a, b, "k").collect()} == {("x", 1), ("y", 1)}
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string")
    right = spark.createDataFrame([(1, "a"), (2, "c"), (3, "")], "k int, v string")
    got = {r.k: r.verdict for r in compare.compare_records(left, right, "k", ["v"]).collect()}
    assert got == {1: "same", 2: "changed", 3: "changed"}


def test_fingerprint_ignores_order(spark):
    rows = spark.createDataFrame([(i, str(i)) for i in range(50)], "a int, b string")
    prints = [compare.table_fingerprint(r, ["a", "b"]).first() for r in (rows, rows.orderBy(F.desc("a")).repartition(3))]
    assert prints[0] == prints[1]


def test_later_donor_takes_the_latest_that_is_not_blank(spark):
    owners = spark.createDataFrame([("k", "o", 1)], "key string, owner string, version int")
    donors = spark.createDataFrame([("k", 1, "same"), ("k", 2, "next"), ("k", 3, " ")], "key string, version int, text string")
    assert bridge.later_donor(owners, donors, ["key"]).first()["text"] == "next"


def test_ratios_of_nothing_are_null(spark):
    row = spark.range(1).select(S.ratio_of(F.lit(1), F.lit(0)).alias("r"), S.percent_of(F.lit(1), F.lit(3)).alias("p")).first()
    assert row.r is None and row.p == 33.3


def test_subject_grammar_round_trip(spark):
    made = S.compose_subject(F.lit("h"), F.lit("1"), F.lit("s"), F.lit("2"), F.lit("x"), F.lit("d"))
    row = spark.range(1).select(S.parse_subject(made).alias("s")).first()["s"]
    assert row.asDict() == {"hub": "h", "hub_version": "1", "source": "s", "source_version": "2", "suffix": "x", "mark": "d"}


def test_block_with_an_unknown_line_fails(spark, tmp_path):
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "part-0.txt").write_text('{"kind": "node", "stableId": "a"}\n{"kind": "other"}\n')
    nodes, _ = blocks.read_block(spark, str(tmp_path))
    with pytest.raises(Exception, match="not a block line"):
        nodes.collect()


def test_first_write_of_a_content_address_wins(spark):
    held = spark.createDataFrame([("a", 1)], "id string, content int")
    new = spark.createDataFrame([("a", 2), ("b", 3), ("b", 4)], "id string, content int")
    fresh, refused = blocks.put_once(held, new, "id", "content")
    assert {tuple(r) for r in fresh.collect()} == {("b", 3)}
    assert {tuple(r) for r in refused.collect()} == {("a", 2)}


def test_checksums(spark, tmp_path):
    import hashlib

    (tmp_path / "a").write_text("x")
    (tmp_path / "b").write_text("y")
    good = hashlib.sha256(b"x").hexdigest()
    listed = spark.createDataFrame([("a", good), ("b", good), ("c", good)], "path string, sha256 string")
    assert {r.path for r in blocks.checksum_failures(spark, str(tmp_path), listed).collect()} == {"b", "c"}


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_workbook_cells_keep_numbers_as_written(spark, tmp_path):
    import zipfile

    from stelae.sources import standards

    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(tmp_path / "a.xlsx", "w") as book:
        book.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>na</t></si><si><r><t>ri</t></r><r><t>ch</t></r></si></sst>")
        cells = '<c r="A1" t="s"><v>1</v></c><c r="B1"><v>1.50</v></c><c r="C1"/><c r="D1" t="inlineStr"><is><t>x</t></is></c>'
        book.writestr("xl/worksheets/sheet1.xml", f"<worksheet {ns}><sheetData><row>{cells}</row></sheetData></worksheet>")
    got = {(r.sheet, r.cell, r.text) for r in standards.xlsx_cells(spark, str(tmp_path)).collect()}
    assert got == {("sheet1", "A1", "rich"), ("sheet1", "B1", "1.50"), ("sheet1", "D1", "x")}


def test_gates_count_unknown_as_failure(spark):
    from stelae.operators import gates, hub

    rows = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    assert {(r.k, r.rule) for r in gates.shape_violations(rows, "k", {"is_a": F.col("v") == "a"}).collect()} == {(2, "is_a")}
    got = gates.gate(rows.where("false"), {"any": F.col("k") > 0}).first()
    assert (got.passed, got.failures) == (False, 0)
    cycle = spark.createDataFrame([(1, 2), (2, 1)], "id int, parent int")
    with pytest.raises(ValueError):
        hub.chain_depths(cycle, most_rounds=3)


def test_partition_file_refuses_repeats(spark, tmp_path):
    from stelae.sources import tables

    (tmp_path / "p.tsv").write_text("object\tlabel\n1\ta\n1\tb\n")
    with pytest.raises(Exception, match="blank or repeated"):
        tables.read_partition(spark, str(tmp_path / "p.tsv"), "object bigint, label string").collect()


def test_fingerprint_tells_every_changed_row(spark):
    import hashlib

    from stelae.operators import compare

    print_of = lambda keys: compare.table_fingerprint(spark.createDataFrame([(k,) for k in keys], "k string"), ["k"]).first()
    lead = {}
    for i in range(3000):
        lead.setdefault(hashlib.sha256(str(i).encode()).hexdigest()[:2], []).append(str(i))
    keys = sorted(lead["7f"], key=lambda k: hashlib.sha256(k.encode()).hexdigest())
    assert len(keys) > 4
    a, b = print_of([keys[0], keys[1], keys[-1]]), print_of([keys[0], keys[2], keys[-1]])
    assert (a.n_rows, a.n_distinct) == (b.n_rows, b.n_distinct) == (3, 3) and a.fingerprint != b.fingerprint
    assert print_of([keys[-1], keys[1], keys[0]]).fingerprint == a.fingerprint


def test_first_write_in_order_wins_and_the_rest_is_refused(spark):
    from stelae.sources import blocks

    held = spark.createDataFrame([("a", 1)], "id string, content int")
    new = [("a", 2, 0), ("a", 1, 5), ("b", 4, 1), ("b", 3, 2), ("b", 4, 9), ("c", 7, 3), ("c", 8, 3), ("d", 5, 4)]
    fresh, refused = blocks.put_once(held, spark.createDataFrame(new, "id string, content int, at int"), "id", "content", "at")
    assert {tuple(r) for r in fresh.collect()} == {("b", 4), ("d", 5)}
    assert {tuple(r) for r in refused.collect()} == {("a", 2), ("b", 3), ("c", 7), ("c", 8)}


def test_vectors_that_cannot_be_compared_take_no_part(spark):
    from stelae.operators import retrieval

    rows = [(1, [1.0, 0.0]), (2, [0.9, 0.1]), (3, None), (4, [1.0]), (5, [float("nan"), 1.0]), (6, [None, 1.0]), (7, [0.0, 1.0])]
    vectors = spark.createDataFrame(rows, "id long, vector array<double>")
    got = {(r.subject, r.card) for r in retrieval.cosine_top_k(vectors, vectors, 1, -1.0, skip_own=True).collect()}
    assert got == {(1, 2), (2, 1), (7, 2)}
    assert retrieval.cosine_top_k(vectors.where("false"), vectors.where("false"), 1, -1.0).count() == 0


def test_reach_goes_on_beyond_any_fixed_depth(spark):
    from stelae.operators import graph

    edges = spark.createDataFrame([(str(i), str(i + 1)) for i in range(20)], "from_id string, to_id string")
    roots = spark.createDataFrame([("0",)], "stable_id string")
    assert graph.reach(edges, roots).count() == 21
    assert graph.reach(edges, roots, most_steps=3).count() == 4


def test_neighbour_counts_are_those_of_the_pairs(spark):
    import random

    from pyspark.sql import functions as F

    from stelae.operators import graph

    draw = random.Random(4)
    rows = [(draw.choice(["OWNS", "OWNS", "REFERS"]), str(draw.randint(0, 14)), str(draw.randint(0, 14))) for _ in range(90)]
    edges = spark.createDataFrame(rows, "type string, from_id string, to_id string")
    want = graph.neighbours(edges, "OWNS").groupBy("stable_id").agg(F.countDistinct("neighbour").alias("n"))
    as_dict = lambda df: {r.stable_id: r.n for r in df.collect()}
    assert as_dict(graph.neighbour_counts(edges, "OWNS")) == as_dict(want)


def test_maps_are_merged_by_sums(spark):
    from pyspark.sql import functions as F

    from stelae.operators import hub

    rows = spark.createDataFrame([([{"a": 1, "b": 2}, {"b": 3, "c": 4}, {}],)], "m array<map<string,bigint>>")
    assert rows.select(hub.merged_sums(F.col("m")).alias("m")).first().m == {"a": 1, "b": 5, "c": 4}


def test_bm25_of_equal_documents_and_queries_against_plain_scores(spark):
    """Kinds of documents and of queries meet, not all of them, and the answers stay whole."""
    import math

    from stelae.operators import fulltext

    draw = random.Random(4)
    texts = [" ".join(draw.choice("abcd") for _ in range(draw.randint(1, 4))) for _ in range(12)] + ["", "z"]
    docs = {i: draw.choice(texts) for i in draw.sample(range(10000), 300)}
    asked = {i: draw.choice([*texts, "A b-a", "nothing"]) for i in range(80)}
    rows = {i: x.split() for i, x in docs.items() if x}
    n, average = len(rows), sum(map(len, rows.values())) / len(rows)
    df = {w: sum(w in x for x in rows.values()) for w in "abcdz"}
    want = set()
    for q, text in asked.items():
        words, scores = {w for w in text.lower().replace("-", " ").split() if df.get(w)}, {}
        for i, x in rows.items():
            parts = [math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * x.count(w) * 2.2 / (x.count(w) + 1.2 * (0.25 + 0.75 * len(x) / average)) for w in words if w in x]
            if parts:
                scores[i] = round(sum(parts), 6)
        best = sorted(scores, key=lambda i: (-scores[i], i))[:5]
        want |= {(q, i, place, scores[i]) for place, i in enumerate(best, 1)}
    index = fulltext.postings(spark.createDataFrame(list(docs.items()), "id long, text string"))
    found = fulltext.bm25_top_k(index, n, average, spark.createDataFrame(list(asked.items()), "query long, text string"), 5)
    assert {(r.query, r.id, r.rank, round(r.score, 6)) for r in found.collect()} == want
    kinds = {(tuple(sorted(x)),) for x in rows.values()}
    assert fulltext._profiles(index, 5).count() <= 5 * len(kinds)


def test_best_of_a_block_against_a_whole_sort():
    import numpy as np

    draw = np.random.default_rng(3)
    for width, k, floor in ((1, 3, 0.1), (7, 7, -3.0), (40, 5, 0.1), (200, 10, 0.5), (200, 10, 2.0)):
        cosine = draw.integers(-4, 5, (30, width)) / 4  # many ties
        cosine[::7, 0] = -np.inf
        ids, who = draw.permutation(width * 3)[:width], np.arange(30) * 2
        order = np.lexsort((np.broadcast_to(ids, cosine.shape), -cosine), axis=1)[:, :k]
        want = [(int(who[i]), int(ids[j]), float(cosine[i, j])) for i in range(30) for j in order[i] if cosine[i, j] >= floor]
        found = retrieval._best(cosine, who, ids, k, floor)
        assert list(zip(found.subject.tolist(), found.card.tolist(), found.cosine.tolist(), strict=True)) == want


def test_neighbours_are_searched_once(spark, small):
    from stelae.plans import registry

    found = registry.queries()["neighbour_top_share"](spark, small)
    assert "MapInPandas" not in found._jdf.queryExecution().executedPlan().toString()
