"""Cards, scores, pools and typed comparisons against plain versions."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from stelae.operators import cards, compare, scoring


def test_cards_slots_and_skips(spark):
    properties = spark.createDataFrame(
        [("p", ["A", "B", "A"], ["S", "C", "S"]), ("q", None, ["S"]), ("r", [], None), ("s", ["A", "?"], ["E"]), ("t", ["C"], ["gone"])],
        "property string, domains array<string>, ranges array<string>",
    )
    classes = spark.createDataFrame([("A",), ("B",), ("C",), ("A",)], "id string")
    values = spark.createDataFrame([("S", "1"), ("S", "2"), ("S", "1"), ("E", None)], "option_set string, value string")
    qualifiers = spark.createDataFrame([("s", "k"), ("s", "k"), ("q", "k")], "property string, qualifier string")
    made, edges, skips = cards.enumerate_cards(properties, classes, values, qualifiers)
    want = {f"p|{d}|||" for d in "AB"} | {f"p|{d}|S|{v}|" for d in "AB" for v in "12"} | {"s|A|||", "s|A|||k", "t|C|||"}
    rows = made.collect()
    assert {r.card for r in rows} == want and len(rows) == len(want)
    assert {r.tier for r in rows if "|S|" in r.card} == {"optionValue"}
    assert {(r.slot, r.base) for r in edges.where("card = 'p|A|S|2|'").collect()} == {("PROPERTY", "p"), ("DOMAIN", "A"), ("RANGE", "S"), ("VALUE", "2")}
    assert edges.where("slot = 'QUALIFIER'").count() == 1
    assert {(r.property, r["at"], r.reason.split()[0] + r.reason.split()[-1]) for r in skips.collect()} == {
        ("q", None, "nodomain"), ("r", None, "nodomain"), ("s", "?", "aclass"), ("s", "E", "anvalues"), ("t", "gone", "aknown"),
    }


def test_scores_against_a_plain_version(spark):
    draw = random.Random(7)
    subjects, names = range(6), [f"c{i}" for i in range(9)]
    domain, rng = {c: f"d{draw.randrange(3)}" for c in names}, {c: draw.choice([None, "r0", "r1"]) for c in names}
    admitted = [(s, c, draw.randrange(1, 4), draw.randrange(3) / 4, draw.randrange(3) / 4) for s in subjects for c in names if draw.random() < 0.8]
    shares = {side: {(s, f"{side[0]}{i}"): draw.randrange(3) / 2 for s in subjects if s for i in range(3)} for side in ("domain", "range")}
    slots = [(c, "DOMAIN", domain[c]) for c in names] + [(c, "RANGE", rng[c]) for c in names if rng[c]] + [(c, "PROPERTY", "x") for c in names]
    frames = [spark.createDataFrame([(s, k, v) for (s, k), v in shares[side].items()], "subject long, class string, share double") for side in ("domain", "range")]
    rows = spark.createDataFrame(admitted, "subject long, card string, own_votes long, card_cosine double, best_cosine double")
    found = scoring.score_candidates(rows, spark.createDataFrame(slots, "card string, slot string, base string"), *frames, k=4).collect()
    want = {}
    for s in subjects:
        scored = []
        for who, c, votes, near, best in admitted:
            if who == s:
                total, both = votes, 0
                for side, base in (("domain", domain[c]), ("range", rng[c])):
                    own = shares[side].get((s, base), 0)
                    most = max([v for (x, _), v in shares[side].items() if x == s], default=0)
                    total += own == most and own > 0
                    both += own
                scored.append((-total, -both, -near, -best, c))
        want.update({(s, x[-1]): (i, -x[0]) for i, x in enumerate(sorted(scored)[:4], 1)})
    assert {(r.subject, r.card): (r["rank"], r.score) for r in found} == want


def test_a_card_with_two_domains_fails(spark):
    rows = spark.createDataFrame([(1, "c", 1, 0.5, 0.5)], "subject long, card string, own_votes long, card_cosine double, best_cosine double")
    slots = spark.createDataFrame([("c", "DOMAIN", "a"), ("c", "DOMAIN", "b")], "card string, slot string, base string")
    none = spark.createDataFrame([], "subject long, class string, share double")
    with pytest.raises(Exception, match="not one domain"):
        scoring.score_candidates(rows, slots, none, none, 3).collect()


def test_pool_faults(spark):
    pool = [(1, "a", 1, 0.9), (1, "b", 2, 0.8), (2, "a", 1, 0.5), (2, "a", 2, 0.6), (3, "a", 2, 0.5), (4, "a", 1, float("nan")), (4, "b", 2, 0.1), (4, "c", 3, 0.1)]
    found = scoring.pool_faults(spark.createDataFrame(pool, "subject long, card string, rank int, cosine double"), 2).collect()
    assert {(r.subject, r.fault) for r in found} == {
        (2, "a card twice"), (2, "cosines out of order"), (3, "ranks with gaps"), (4, "too many seats"), (4, "a cosine that is no number"),
    }


def test_retrieval_report(spark):
    pool = [("d1", "a", 0.9, False), ("d1", "b", 0.8, True), ("d1", "c", 0.1, True), ("d2", "x", 0.5, False), ("d3", "y", 0.5, False), ("d3", "z", 0.7, False)]
    decisions = [("d1", "pick", "c"), ("d2", "pick", "x"), ("d3", "abstention", None), ("d4", "pick", "gone")]
    got = scoring.retrieval_report(spark.createDataFrame(decisions, "decision string, outcome string, choice string"), spark.createDataFrame(pool, "decision string, card string, cosine double, nominated boolean"), 2)
    held = {r.metric: r.value for r in got.collect()}
    assert held["picks"] == 3 and held["picks outside their pool"] == 1 and held["rescues"] == 1 and held["first by cosine"] == 1 and held["within the cutoff"] == 1
    assert held["median pool"] == 2 and held["mean pool"] == 2 and held["outcome abstention"] == 1 and held["rank 2-3"] == 1 and held["pools without nomination"] == 2


def test_graphs_and_blocks(spark):
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "id string")
    found = compare.compare_graphs(ids("a", "b"), ids("b", "c"), ids("e"), ids("e"), "id").collect()
    assert {(r.what, r.id, r.side) for r in found} == {("nodes", "a", "missing"), ("nodes", "c", "extra")}
    with pytest.raises(ValueError, match="new_edges"):
        compare.compare_graphs(ids("a"), ids("a"), ids("e"), None, "id")
    block = "pair string, text string, fingerprint string, version string"
    a = [("same", "t f1", "f1", "1"), ("print", "t f1 u", "f1", "1"), ("head", "t f1", "f1", "1"), ("body", "t f1", "f1", "1"), ("only", "t", "f1", "1")]
    b = [("same", "t f1", "f1", "1"), ("print", "t f2 u", "f2", "1"), ("head", "t2 f2", "f2", "2"), ("body", "t3 f2", "f2", "1"), ("new", "t", "f1", "1")]
    got = {r.pair: (r.verdict, r.differing) for r in compare.compare_blocks(spark.createDataFrame(a, block), spark.createDataFrame(b, block), ["version"]).collect()}
    assert got == {"same": ("IDENTICAL", None), "print": ("ONLY_FINGERPRINT_DIFFERS", None), "head": ("DIFFERENT", ["version"]), "body": ("DIFFERENT", ["body"]), "only": ("BASELINE_ONLY", None), "new": ("CANDIDATE_ONLY", None)}


def test_typed_values_tell_types_apart(spark):
    row = spark.sql("""SELECT 1 AS a, 1.0D AS b, '1' AS c, true AS d, array(2, 1) AS e, array(1, 2) AS f, map('y', 1, 'x', 2) AS g, map('x', 2, 'y', 1) AS h,
      -0.0D AS i, 0.0D AS j, CAST(NULL AS INT) AS k, binary('1') AS l, named_struct('q', 'a"b', 'p', array('[', ']')) AS m, array('1') AS n, 'null' AS o, DATE'2024-01-01' AS p""")
    found = row.select(*[compare.typed_value(F.col(f.name), f.dataType).alias(f.name) for f in row.schema]).first().asDict()
    assert found["g"] == found["h"] and len(set(found.values())) == len(found) - 1
    assert found["m"] == '["map",[["p",["list",[["str","["],["str","]"]]]],["q",["str","a\\"b"]]]]' and found["k"] == '["null"]'


def test_set_digests(spark):
    draw = random.Random(3)
    hashes = [hashlib.sha256(str(draw.randrange(300)).encode()).hexdigest() for _ in range(400)]
    frame = lambda x: spark.createDataFrame([(h,) for h in x], "h string")
    one = compare.set_digest(frame(hashes), "h").first()
    assert one.n == 400 and compare.set_digest(frame(hashes[::-1]).repartition(5), "h").first() == one
    assert compare.set_digest(frame(hashes[1:]), "h").first().digest != one.digest
    assert compare.set_digest(frame([]), "h").first().n == 0
