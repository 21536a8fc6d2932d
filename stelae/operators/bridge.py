"""Mapping operators: keys, tuples, classification, planned edges, conflicts, agreement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stelae.functions.scalars import ratio_of


def contention(cards: DataFrame, key: str) -> DataFrame:
    """One row: cards, distinct keys, keys that several cards share, the worst share."""
    held = cards.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return held.agg(
        F.sum("n").alias("n_cards"),
        F.count(F.lit(1)).alias("n_keys"),
        F.count_if(F.col("n") > 1).alias("n_contended"),
        F.max("n").alias("worst"),
    )


def tuple_filter(pool: DataFrame, supplied: dict[str, Column]) -> DataFrame:
    """Cards whose fields equal all that are supplied; lists compare sorted."""
    for name, value in supplied.items():
        own = F.array_sort(name) if dict(pool.dtypes)[name].startswith("array") else F.col(name)
        wanted = F.array_sort(value) if dict(pool.dtypes)[name].startswith("array") else value
        pool = pool.where(own == wanted)
    return pool


def eliminations(pool: DataFrame, supplied: dict[str, Column]) -> DataFrame:
    """field, eliminated: how many cards each supplied field alone rules out."""
    counts = [F.count_if(~F.col(n).eqNullSafe(v)).alias(n) for n, v in supplied.items()]
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("field"), F.col(n).alias("eliminated")) for n in supplied]))
    return pool.agg(*counts).select(pairs.alias("x")).select("x.*")


def first_match(rules: list[tuple[str, Column]], otherwise: str) -> Column:
    """The name of the first rule that holds."""
    out = F.lit(otherwise)
    for name, holds in reversed(rules):
        out = F.when(holds, F.lit(name)).otherwise(out)
    return out


def planned_edges(records: DataFrame) -> DataFrame:
    """records (subject, object, predicate, instances) -> one edge per instance, or of
    the subject itself where there is none."""
    ends = F.when(F.size("instances") > 0, F.col("instances")).otherwise(F.array("subject"))
    return records.select(F.explode(ends).alias("from_id"), "object", "predicate")


def sibling_conflicts(edges: DataFrame) -> DataFrame:
    """edges (block, from_id, object): what a from-node maps to in one block and not in
    another block that maps it as well."""
    edges = edges.select("block", "from_id", "object").distinct()
    other = edges.select(F.col("block").alias("other"), "from_id").distinct()
    pairs = edges.join(other, "from_id").where(F.col("block") != F.col("other"))
    theirs = edges.select(F.col("block").alias("other"), "from_id", "object")
    return pairs.join(theirs, ["other", "from_id", "object"], "left_anti").select("block", "other", "from_id", "object")


def agreement(units: DataFrame, dimensions: list[str]) -> DataFrame:
    """units (judge, rater, dimensions): tallies and rate for each dimension and all."""
    sets = units.groupingSets([[F.col(d)] for d in dimensions] + [[]], *dimensions)
    return sets.agg(
        F.count(F.lit(1)).alias("units"),
        F.count_if(F.col("judge") == F.col("rater")).alias("agreed"),
        F.count_if((F.col("judge") != F.col("rater"))).alias("differed"),
    ).withColumn("rate", ratio_of(F.col("agreed"), F.col("units")))


def digest_judge(prompt: Column, pool: Column, abstain_slots: int) -> Column:
    """A place from 1 to pool, or 0 (abstains), by the prompt's digest alone."""
    number = F.conv(F.substring(F.sha2(prompt, 256), 1, 8), 16, 10).cast("long")
    slot = F.pmod(number, pool + abstain_slots)
    return F.when(slot < pool, slot + 1).otherwise(F.lit(0)).cast("long")


def collapsed(cards: DataFrame, pool: str, rendering: str, place: str, member: str) -> DataFrame:
    """Cards of a pool that render alike become one: the first stands, members sorted."""
    return cards.groupBy(pool, rendering).agg(
        F.min_by(member, place).alias("stands"), F.array_sort(F.collect_list(member)).alias("members"), F.min(place).alias("place")
    )


def later_donor(owners: DataFrame, donors: DataFrame, keys: list[str]) -> DataFrame:
    """owners (keys, owner, version), donors (keys, version, text): the text of the
    latest donor that is later than the owner and not blank."""
    fit = donors.where(F.btrim("text") != "").select(*keys, F.col("version").alias("donor_version"), "text")
    found = owners.join(fit, keys).where("donor_version > version")
    return found.groupBy("owner").agg(F.max("donor_version").alias("donor_version"), F.max_by("text", "donor_version").alias("text"))


def latest(rows: DataFrame, key: str, order: str) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(order)))
    return rows.withColumn("place", place).where("place = 1").drop("place")


def page(rows: DataFrame, order: list, number: int, size: int) -> DataFrame:
    """A 1-based page of at most 1,000 rows in a total order."""
    if number < 1 or not 1 <= size <= 1000:
        raise ValueError("pages count from 1 and hold 1 to 1000 rows")
    return rows.orderBy(*order).offset((number - 1) * size).limit(size)


def first_judge(pool: Column) -> Column:
    """Always the first place of a pool; a pool without cards has none (0)."""
    return F.when(pool > 0, F.lit(1)).otherwise(F.lit(0)).cast("long")


def abstaining_judge() -> Column:
    return F.lit(0).cast("long")


def planned_order(edges: DataFrame, first: list[str], place: str = "place") -> DataFrame:
    """A zero-based place within each value of the first column, by the columns after it."""
    order = Window.partitionBy(first[0]).orderBy(*first[1:])
    return edges.withColumn(place, (F.row_number().over(order) - 1).cast("long"))


def declared_target(text: Column, rules: list[tuple[str, str]]) -> Column:
    """rules (pattern with one group, prefix), in order: the prefix and the group of the
    first pattern that the text fits; null where none does."""
    found = F.lit(None).cast("string")
    for pattern, prefix in reversed(rules):
        found = F.when(text.rlike(pattern), F.concat(F.lit(prefix), F.regexp_extract(text, pattern, 1))).otherwise(found)
    return found
