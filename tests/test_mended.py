"""Cases that earlier versions got wrong."""

import numpy as np
from pyspark.sql import functions as F

from stelae.operators import bridge, compare, hub, retrieval
from stelae.runtime import new_shared_path
from stelae.sources import standards
from stelae.streaming import event_log


def test_record_hashes_keep_values_apart(spark):
    rows = [("a\x1fb", "c"), ("a", "b\x1fc"), ("\x00", "x"), (None, "x"), ("\x1en", "x"), ("", "x"), ("\x1es", ""), ("\x1f", "")]
    found = spark.createDataFrame(rows, "a string, b string").select(compare.record_hash([F.col("a"), F.col("b")]).alias("h")).collect()
    assert len({r.h for r in found}) == len(rows)
    a, b = (spark.createDataFrame([(1, *r)], "k long, a string, b string") for r in rows[:2])
    assert compare.compare_records(a, b, "k", ["a", "b"]).first().verdict == "changed"


def test_digest_references_tell_null_and_lines_apart(spark):
    parts = "p string, q string"
    names = spark.createDataFrame([("n1", None, "x"), ("n2", "", "x"), ("n3", "a\nb", "c"), ("n4", "t", "t"), ("n5", "t", "t")], f"name string, {parts}")
    shapes = spark.createDataFrame([(1, "", None, "x"), (2, "", "", "x"), (3, "", "a", "b\nc"), (4, "n5", "t", "t"), (5, "n1", "t", "t")], f"id long, title string, {parts}")
    assert {r.id: r.name for r in standards.digest_references(shapes, names, ["p", "q"]).collect()} == {1: "n1", 2: "n2", 3: None, 4: "n5", 5: None}


def test_vectors_of_each_length_are_compared(spark):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.1]), (3, [1.0]), (4, [2.0]), (5, []), (6, [1.0, 2.0, 3.0])]
    vectors = spark.createDataFrame(rows, "id long, vector array<double>")
    got = {(r.subject, r.card) for r in retrieval.cosine_top_k(vectors, vectors, 1, -1.0, skip_own=True).collect()}
    assert got == {(1, 2), (2, 1), (3, 4), (4, 3)}


def test_late_rows_count_in_every_batch(spark):
    path = new_shared_path(spark, "events")
    days = ["2024-03-01 10:00:00", "2024-01-01 10:30:00", "2024-02-01 10:00:00", "2024-01-01 10:59:00", "2024-03-01 10:10:00"]
    for i, day in enumerate(days):
        spark.createDataFrame([(day, "click", 1.5)], "ts string, event_type string, value double").select(
            F.col("ts").cast("timestamp").alias("ts"), "event_type", "value"
        ).coalesce(1).write.parquet(f"{path}/{i}.parquet")
    schema = "ts timestamp, event_type string, value double"
    whole = new_shared_path(spark, "flat")
    spark.read.parquet(*[f"{path}/{i}.parquet" for i in range(5)]).repartition(5).write.parquet(whole)
    got = {(str(r.hour), r.n, r.usd) for r in event_log.hourly_totals(spark, f"{whole}/", schema, files_at_a_time=1).collect()}
    assert got == {("2024-03-01 10:00:00", 2, 3.0), ("2024-01-01 10:00:00", 2, 3.0), ("2024-02-01 10:00:00", 1, 1.5)}


def test_rules_are_applied_as_patterns(spark):
    rows = spark.createDataFrame([("red ring",), ("ring",), ("red  x",), ("blue",), ("reddish box y",), (None,)], "t string")
    rules = [(r"^(?=.*ring$)([^ ]*)", "ring:"), (r"^red[^ ]* ([^ ]*)", "red:")]
    got = {r.t: r.x for r in rows.select("t", bridge.declared_target(F.col("t"), rules).alias("x")).collect()}
    assert got == {"red ring": "ring:red", "ring": "ring:ring", "red  x": "red:", "blue": None, "reddish box y": "red:box", None: None}


def test_capped_lists_gather_no_group(spark):
    rows = spark.range(1000).selectExpr("id % 2 as g", "id div 2 % 40 as v").unionByName(spark.createDataFrame([(5, 1), (5, 1)], "g long, v long"))
    found = hub.capped_lists(rows, "g", "v", 3)
    assert {r.g: r["sample"] for r in found.collect()} == {0: "0,1,2 +37 more", 1: "0,1,2 +37 more", 5: "1"}
    assert "WindowGroupLimit" in found._jdf.queryExecution().executedPlan().toString()


def test_vectors_as_text_and_back(spark):
    draw = np.random.default_rng(1)
    rows = [(i, [float(x) for x in draw.normal(size=n).astype(np.float32)]) for i, n in enumerate([3, 0, 64, 1])] + [(9, None)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").coalesce(1)
    text = hub.encoded_vectors(vectors)
    assert {r.vec_id: r.width for r in text.collect()} == {0: 3, 1: 0, 2: 64, 3: 1, 9: None}
    assert {r.vec_id: r.vector for r in hub.decoded_vectors(text).collect()} == dict(rows)
