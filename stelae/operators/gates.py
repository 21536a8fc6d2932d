"""Validation and audit: violations as rows, verdicts as columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def shape_violations(rows: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """key, rule for every rule that a row breaks; a rule that is null is broken."""
    broken = F.array(*[F.when(~F.coalesce(holds, F.lit(False)), F.lit(name)) for name, holds in rules.items()])
    return rows.select(key, F.explode(F.filter(broken, lambda r: r.isNotNull())).alias("rule"))


def gate(rows: DataFrame, conjuncts: dict[str, Column]) -> DataFrame:
    """conjunct, passed, failures: each condition over all rows; a gate of no rows fails."""
    counts = [F.count_if(~F.coalesce(c, F.lit(False))).alias(n) for n, c in conjuncts.items()]
    one = rows.agg(F.count(F.lit(1)).alias("n_rows"), *counts)
    pairs = F.array(*[F.struct(F.lit(n).alias("conjunct"), F.col(n).alias("failures")) for n in conjuncts])
    out = one.select("n_rows", F.explode(pairs).alias("x")).select("n_rows", "x.*")
    return out.select("conjunct", ((F.col("failures") == 0) & (F.col("n_rows") > 0)).alias("passed"), "failures")


def inter_rater(answers: DataFrame) -> DataFrame:
    """answers (element, rater, choice) -> elements with several raters: raters, distinct
    choices, and the share of the commonest choice."""
    by = answers.groupBy("element", "choice").agg(F.countDistinct("rater").alias("n"))
    whole = answers.groupBy("element").agg(F.countDistinct("rater").alias("raters"))
    held = by.groupBy("element").agg(F.max("n").alias("most"), F.count(F.lit(1)).alias("choices"))
    found = held.join(whole, "element").where("raters > 1")
    return found.select("element", "raters", "choices", F.round(F.col("most") / F.col("raters"), 4).alias("agreement"))


def residue(live: DataFrame, known: DataFrame, patterns: list[str], name: str = "name") -> DataFrame:
    """Names in use that neither the catalogue nor a producer's pattern accounts for."""
    left = live.select(name).distinct().join(known.select(name), name, "left_anti")
    for pattern in patterns:
        left = left.where(~F.col(name).rlike(pattern))
    return left


def newest(rows: DataFrame, key: str, created: str, tie: str) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(created), tie))
    return rows.withColumn("place", place).where("place = 1").drop("place")


def top_n(rows: DataFrame, key: str, order: list, most: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return rows.withColumn("place", place).where(F.col("place") <= most)


def cache_misses(asked: DataFrame, cache: DataFrame, key: str) -> DataFrame:
    """Distinct keys that a provider still has to be asked for."""
    return asked.select(key).distinct().join(cache.select(key), key, "left_anti")
