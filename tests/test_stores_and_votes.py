"""Store folds, inversions and the voting walk."""

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from stelae.operators import voting
from stelae.operators.inversions import count_inversions, inversions, numbered
from stelae.runtime import new_shared_path
from stelae.sources import fold

RULES = [
    fold.TableRule("people", ("id",), ("name",)),
    fold.TableRule("acts", ("id", "part"), ("what",), "pair", "seq", ("seq",), ((("owner",), "people", ("id",)),)),
]
PEOPLE, ACTS = "id long, name string", "id long, part string, what string, pair string, owner long, seq long"


@pytest.fixture
def store(spark):
    held = fold.Store(spark, new_shared_path(spark, "store"))
    people = spark.createDataFrame([(1, "a"), (2, "b")], PEOPLE)
    acts = spark.createDataFrame([(1, "x", "w", "p", 1, 1), (2, None, "w", "q", 2, 2), (3, "x", None, "q", 2, 3)], ACTS)
    held.commit({"people": held.stage("people", people), "acts": held.stage("acts", acts)}, 0)
    return held


def _source(spark, acts, people=((3, "c"),)):
    return {"people": spark.createDataFrame(list(people), PEOPLE), "acts": spark.createDataFrame(list(acts), ACTS)}


def _rows(df):
    return sorted(map(str, map(tuple, df.collect())))


def test_fold_plan_counts(spark, store):
    acts = [(1, "x", "w", "p", 1, 9), (2, None, "other", "q", 2, 8), (3, "x", None, "q", 2, 7), (4, "x", "n", "q", 1, 10), (4, "x", "n", "q", 1, 11), (5, "x", "n", "new", 1, 12)]
    plan = {r.table_name: r for r in fold.plan_fold(_source(spark, acts), store, RULES, 2).collect()}
    got = plan["acts"]
    assert (got.source_rows, got.target_rows, got.missing, got.overlap, got.repeated) == (6, 3, 3, 3, 1)
    assert (got.conflicts, got.order_conflicts, got.inversions) == (1, 1, 3)
    assert fold.plan_fold(_source(spark, acts), store, RULES, 3).where("order_conflicts > 0").count() == 0
    found = fold.conflicts(_source(spark, acts)["acts"], store.read("acts"), RULES[1]).collect()
    assert [(r.id, r.differing) for r in found] == [(2, ["what"])]


def test_fold_appends_all_tables_and_numbers_anew(spark, store):
    acts = [(1, "x", "w", "p", 1, 50), (9, "x", "n", "r", 3, 70), (8, "x", "n", "r", 1, 60), (7, None, "n", None, None, 80)]
    report = fold.apply_fold(_source(spark, acts), store, RULES, 3)
    assert _rows(report) == ["('acts', 3, 3, 6)", "('people', 2, 1, 3)"]
    assert {r.id: r.seq for r in store.read("acts").collect()} == {1: 1, 2: 2, 3: 3, 8: 4, 9: 5, 7: 6}
    again = fold.apply_fold(_source(spark, acts), store, RULES, 6)
    assert _rows(again) == ["('acts', 6, 0, 6)", "('people', 3, 0, 3)"]


@pytest.mark.parametrize("acts,why", [
    ([(1, "x", "changed", "p", 1, 9)], "conflicts"),
    ([(4, "x", "n", "q", 1, 9)], "order conflicts"),
    ([(5, "x", "n", "new", 1, 9), (5, "x", "n", "new", 1, 10)], "repeated"),
    ([(5, "x", "n", "new", 77, 9)], "parent"),
])
def test_refused_folds_leave_nothing(spark, store, acts, why):
    before = store.version(), _rows(store.read("acts")), _rows(store.read("people"))
    with pytest.raises(fold.Refused, match=why):
        fold.apply_fold(_source(spark, acts), store, RULES, None if why == "order conflicts" else 3)
    assert (store.version(), _rows(store.read("acts")), _rows(store.read("people"))) == before
    assert store.sweep() == 0


def test_lacking_columns_are_refused(spark, store):
    source = _source(spark, [(5, "x", "n", "new", 1, 9)])
    source["acts"] = source["acts"].withColumn("later", F.lit(1))
    with pytest.raises(fold.Refused, match="later"):
        fold.apply_fold(source, store, RULES, 3)
    assert store.version() == 1


def test_a_killed_apply_leaves_the_store_unchanged(spark, store, monkeypatch):
    source, before = _source(spark, [(5, "x", "n", "new", 1, 9)]), _rows(store.read("acts"))
    # Killed between the last segment and the marker: nothing cleans up after it.
    monkeypatch.setattr(fold.Store, "commit", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt))
    monkeypatch.setattr(fold.Store, "discard", lambda *a: None)
    with pytest.raises(KeyboardInterrupt):
        fold.apply_fold(source, store, RULES, 3)
    monkeypatch.undo()
    assert store.version() == 1 and _rows(store.read("acts")) == before
    assert store.sweep() == 2 and store.sweep() == 0
    fold.apply_fold(source, store, RULES, 3)
    assert store.version() == 2 and store.read("acts").count() == 4


def test_the_second_of_two_writers_is_refused(spark, store):
    one = store.stage("people", spark.createDataFrame([(7, "g")], PEOPLE))
    store.commit({"people": one}, 1)
    with pytest.raises(fold.Refused, match="meanwhile"):
        store.commit({"people": store.stage("people", spark.createDataFrame([(8, "h")], PEOPLE))}, 1)
    assert {r.id for r in store.read("people").collect()} == {1, 2, 7}


def test_fold_into_an_empty_store(spark):
    empty = fold.Store(spark, new_shared_path(spark, "store"))
    assert empty.version() == 0 and empty.read("acts") is None
    fold.apply_fold(_source(spark, [(5, "x", "n", "new", 3, 9), (6, "x", "n", "new", 3, 8)]), empty, RULES)
    assert {r.id: r.seq for r in empty.read("acts").collect()} == {6: 1, 5: 2}


def _turned(pairs):
    return sum(1 for a in pairs for b in pairs if a[0] < b[0] and a[1] > b[1])


@pytest.mark.parametrize("n,spread", [(0, 9), (1, 9), (400, 20), (700, 10**12)])
def test_inversions_against_all_pairs(spark, n, spread):
    draw = random.Random(n)
    pairs = [(draw.randrange(-spread, spread), draw.randrange(spread)) for _ in range(n)]
    rows = spark.createDataFrame(pairs + [(None, 1), (1, None)], "x long, y long")
    assert inversions(rows, "x", "y") == _turned(pairs)


def test_inversions_within_groups():
    draw = np.random.default_rng(2)
    values, group = draw.integers(0, 30, 300), draw.integers(0, 4, 300)
    want = sum(values[i] > values[j] and group[i] == group[j] for i in range(300) for j in range(i + 1, 300))
    assert count_inversions(values, group) == want


def test_numbers_go_on_over_ranges(spark):
    rows = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("x")).repartition(7)
    got = {r.x: r.n for r in numbered(rows, ["x"], "n", 10).collect()}
    assert got == {i: i + 11 for i in range(5000)}


def _case(spark, seed):
    draw = random.Random(seed)
    hits = [(s, f"t{s}{i}", f"h{draw.randrange(12)}", draw.randrange(4) / 4) for s in range(5) for i in range(6) for _ in range(3)]
    described = [(f"h{i}", f"b{draw.randrange(9)}") for i in range(12) for _ in range(2)]
    slots = [(f"b{draw.randrange(8)}", draw.choice(["PROPERTY", "RANGE"]), f"c{draw.randrange(10)}") for _ in range(30)]
    texts = [(s, f"t{s}{i}", [draw.randrange(1, 3) * 1.0, draw.randrange(1, 3) * 1.0]) for s in range(5) for i in range(6)]
    cards = [(f"c{i}", [draw.randrange(1, 3) * 1.0, 1.0]) for i in range(10)]
    frames = (
        spark.createDataFrame(hits, "subject long, text string, hit_text string, cosine double"), spark.createDataFrame(described, "hit_text string, base string"),
        spark.createDataFrame(slots, "base string, slot string, card string"), spark.createDataFrame(texts, "subject long, text string, vector array<double>"),
        spark.createDataFrame(cards, "card string, vector array<double>"),
    )
    return hits, described, slots, texts, cards, frames


@pytest.mark.parametrize("seed", [1, 2])
def test_votes_against_a_plain_walk(spark, seed):
    hits, described, slots, texts, cards, frames = _case(spark, seed)
    paths = defaultdict(list)
    for s, t, h, c in hits:
        for h2, b in described:
            for b2, slot, card in slots:
                if h == h2 and b == b2:
                    paths[s, card].append((t, h, b, slot, c))
    whole = dict(cards)
    want, seen = {}, {}
    for s in range(5):
        scored = []
        for (who, card), own in paths.items():
            if who == s and any(p[3] == "PROPERTY" for p in own):
                near = []
                for s2, t, v in texts:
                    if s2 == s:
                        w = whole[card]
                        near.append((-(v[0] * w[0] + v[1] * w[1]) / (np.sqrt(v[0] ** 2 + v[1] ** 2) * np.sqrt(w[0] ** 2 + w[1] ** 2)), t))
                scored.append((-len({p[0] for p in own}), min(near)[0], -max(p[4] for p in own), card, min(near)[1]))
        scored.sort()
        for seat, row in enumerate(scored[:4], 1):
            alike = [x for x in scored if x[:3] == row[:3]]
            first = scored.index(alike[0]) + 1
            want[s, row[3]] = (seat, first, len(alike), first + len(alike) - 1 > 4, row[4])
            seen[s, row[3]] = sorted(paths[s, row[3]])
    seated, walked = voting.vote(*frames, k=4)
    assert {(r.subject, r.card): (r.seat, r.tie_class, r.ties, r.cut, r.best_text) for r in seated.collect()} == want
    got = defaultdict(list)
    for r in voting.evidence(walked, seated).orderBy("place").collect():
        got[r.subject, r.card].append((r.text, r.hit_text, r.base, r.slot, r.cosine))
    assert {k: [x[:4] for x in v] for k, v in got.items()} == {k: [x[:4] for x in v] for k, v in seen.items()}


def test_seats_are_limited_before_the_shuffle(spark):
    scored = spark.range(1000).selectExpr("id % 3 as subject", "id as card", "id % 7 as own_votes", "0.5d as card_cosine", "0.5d as best_cosine")
    plan = voting.seats(scored, 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2
    found = voting.seats(scored, 5).collect()
    assert len(found) == 15 and all(r.own_votes == 6 and r.cut for r in found)


def test_a_card_that_cannot_be_compared_fails(spark):
    admitted = spark.createDataFrame([(1, "c", 1, 1, 0.5)], "subject long, card string, own_votes long, paths long, best_cosine double")
    texts = spark.createDataFrame([(1, "t", [0.0, 0.0])], "subject long, text string, vector array<double>")
    cards = spark.createDataFrame([("c", [1.0, 2.0])], "card string, vector array<double>")
    with pytest.raises(Exception, match="no vector to compare: card c"):
        voting.card_texts(admitted, texts, cards).collect()


def test_texts_that_vote_twice(spark):
    texts = spark.createDataFrame([(1, "t"), (1, "t"), (2, "t")], "subject long, text string")
    assert [(r.subject, r.text) for r in voting.repeated_texts(texts).collect()] == [(1, "t")]
