"""Stores folded into each other."""

from __future__ import annotations

from pyspark.sql import functions as F

from stelae.plans.model import Tables
from stelae.plans.registry import query
from stelae.runtime import new_shared_path
from stelae.sources import fold

RULES = [
    fold.TableRule("owners", ("c_custkey",), ("c_name", "c_nationkey")),
    fold.TableRule(
        "decisions", ("o_orderkey",), ("o_totalprice", "o_orderpriority"), "o_custkey", "seq", ("seq",), ((("o_custkey",), "owners", ("c_custkey",)),)
    ),
]


def _orders(t: Tables, *status: str):
    return t.orders.where(F.col("o_orderstatus").isin(*status)).select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", "o_orderdate")


def _target(t: Tables, *status: str) -> fold.Store:
    """Orders written in the order of their keys, and the customers of one part of the
    market absent."""
    store = fold.Store(t.spark, new_shared_path(t.spark, "store"))
    decisions = _orders(t, *status).drop("o_orderdate").withColumn("seq", F.col("o_orderkey"))
    owners = t.customer.where("c_mktsegment <> 'BUILDING'").select("c_custkey", "c_name", "c_nationkey")
    store.commit({"decisions": store.stage("decisions", decisions), "owners": store.stage("owners", owners)}, 0)
    return store


def _source(t: Tables, *status: str) -> dict:
    """Orders written by date."""
    seq = F.unix_date(F.to_date("o_orderdate")).cast("long") * (1 << 32) + F.col("o_orderkey")
    decisions = _orders(t, *status).withColumn("seq", seq).drop("o_orderdate")
    return {"owners": t.customer.select("c_custkey", "c_name", "c_nationkey"), "decisions": decisions}


@query("""WITH tgt AS (SELECT *, o_orderkey AS seq FROM orders WHERE o_orderstatus IN ('F', 'O')),
src AS (SELECT o_orderkey, o_custkey, o_totalprice, CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN '3-MEDIUM' ELSE o_orderpriority END AS o_orderpriority,
  (o_orderdate::DATE - DATE '1970-01-01') * 4294967296 + o_orderkey AS seq FROM orders WHERE o_orderstatus IN ('O', 'P')),
m AS (SELECT s.*, t.o_orderkey IS NOT NULL AS there, t.seq AS their_seq, t.o_totalprice IS DISTINCT FROM s.o_totalprice OR t.o_orderpriority IS DISTINCT FROM s.o_orderpriority AS differs
  FROM src s LEFT JOIN tgt t USING (o_orderkey)),
latest AS (SELECT o_custkey, max(seq) AS latest FROM tgt GROUP BY 1)
SELECT 'decisions' AS table_name, count(*) AS source_rows, (SELECT count(*) FROM tgt) AS target_rows, count(*) FILTER (WHERE NOT there) AS missing,
  count(*) FILTER (WHERE there) AS overlap, 0::BIGINT AS repeated, count(*) FILTER (WHERE there AND differs) AS conflicts,
  (SELECT count(DISTINCT o_custkey) FROM m JOIN latest USING (o_custkey) WHERE NOT there AND latest > (SELECT max(o_orderkey) FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01' AND o_orderstatus = 'F' AND o_orderpriority = '5-LOW') // 2) AS order_conflicts,
  (SELECT count(*) FROM m a JOIN m b ON a.seq < b.seq AND a.their_seq > b.their_seq AND a.there AND b.there) AS inversions FROM m
UNION ALL SELECT 'owners', count(*), count(*) FILTER (WHERE c_mktsegment <> 'BUILDING'), count(*) FILTER (WHERE c_mktsegment = 'BUILDING'),
  count(*) FILTER (WHERE c_mktsegment <> 'BUILDING'), 0, 0, 0, 0 FROM customer""")
def store_fold_plan(t: Tables):
    source = _source(t, "O", "P")
    priority = F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "3-MEDIUM").otherwise(F.col("o_orderpriority"))
    source["decisions"] = source["decisions"].withColumn("o_orderpriority", priority)
    # The source was taken from the target when half the orders up to this one were written.
    old = t.orders.where("o_orderdate < timestamp '1996-01-01' and o_orderstatus = 'F' and o_orderpriority = '5-LOW'")
    threshold = old.agg(F.max("o_orderkey")).first()[0] // 2
    return fold.plan_fold(source, _target(t, "F", "O"), RULES, threshold)


@query("""WITH src AS (SELECT *, row_number() OVER (ORDER BY o_orderdate::DATE, o_orderkey) + (SELECT max(o_orderkey) FROM orders WHERE o_orderstatus <> 'P') AS seq
  FROM orders WHERE o_orderstatus = 'P'),
tgt AS (SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority, seq FROM src UNION ALL
  SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority, o_orderkey FROM orders WHERE o_orderstatus <> 'P')
SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority, seq, (SELECT count(*) FROM customer) AS owners FROM tgt""")
def store_fold_apply(t: Tables):
    store = _target(t, "F", "O")
    last = store.read("decisions").agg(F.max("seq")).first()[0]
    fold.apply_fold(_source(t, "P"), store, RULES, last)
    return store.read("decisions").withColumn("owners", F.lit(store.read("owners").count()))
