"""A text index: postings with term frequencies, and BM25 scores by joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stelae.runtime import stored

K1, B = 1.2, 0.75


def terms(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def postings(docs: DataFrame) -> DataFrame:
    """docs (id, text) -> term, id, tf, length."""
    rows = docs.select("id", terms(F.col("text")).alias("terms")).select("id", F.size("terms").alias("length"), F.explode("terms").alias("term"))
    return rows.groupBy("term", "id", "length").agg(F.count(F.lit(1)).alias("tf"))


def _profiles(index: DataFrame, k: int) -> DataFrame:
    """-> profile, id: documents of equal terms, frequencies and length, named by the least
    of them; the k least of each."""
    bag = F.array_sort(F.collect_list(F.struct("term", "tf")))
    docs = index.groupBy("id", "length").agg(F.sha2(F.to_json(F.struct(F.col("length"), bag.alias("bag"))), 256).alias("bag"))
    same = Window.partitionBy("bag").orderBy("id")
    return docs.select(F.min("id").over(same).alias("profile"), "id", F.row_number().over(same).alias("place")).where(F.col("place") <= k).drop("place")


def bm25_top_k(index: DataFrame, n_docs: int, average: float, queries: DataFrame, k: int) -> DataFrame:
    """index: postings; queries (query, text) -> query, id, score (6 places), rank: the k
    best of each query, ties to the smaller id. A term that a query repeats counts once.

    Documents that hold the same terms as often have one score with every query, and
    queries of the same terms one answer, so each kind of query meets each kind of document
    once; of a kind of document no more than its k least ids can be among the best."""
    seen = index.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    asked = queries.select("query", F.array_sort(F.array_distinct(terms(F.col("text")))).alias("terms"))
    asked = stored(asked.withColumn("kind", F.sha2(F.to_json("terms"), 256)), "asked")
    wanted = asked.groupBy("kind").agg(F.first("terms").alias("terms")).select("kind", F.explode("terms").alias("term"))
    wanted = wanted.join(seen, "term").withColumn("idf", F.log(1 + (n_docs - F.col("df") + 0.5) / (F.col("df") + 0.5)))
    members = stored(_profiles(index, k), "profiles")
    held = index.join(members.select(F.col("profile").alias("id")).distinct(), "id", "left_semi").withColumnRenamed("id", "profile")
    weight = F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("length") / average))
    scores = wanted.join(held, "term").groupBy("kind", "profile").agg(F.round(F.sum(F.col("idf") * weight), 6).alias("score"))

    def best(rows: DataFrame, name: str) -> DataFrame:
        order = Window.partitionBy("kind").orderBy(F.desc("score"), name)
        return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    # Before each id of the k best stand fewer than k profiles.
    found = best(best(scores, "profile").drop("rank").join(members, "profile"), "id")
    return asked.select("query", "kind").join(found, "kind").select("query", "id", "score", "rank")
