"""Reference cards of a hub: every property in each of its domains, alone and with each
value that it may take there.

properties (property, domains, ranges: lists of ids; null or empty where there are none),
classes (id), option_values (option_set, value), qualifiers (property, qualifier). A card is
an address: property, domain, option set, value, qualifier. All is exploded and joined, so
that one property with very many values is spread like any other rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stelae.functions import scalars as S
from stelae.runtime import stored

ADDRESS = ("property", "domain", "option_set", "value", "qualifier")
#: The tiers of cards, and the slots by which a card hangs on the base.
PROPERTY_TIER, VALUE_TIER = "property", "optionValue"
SLOTS = {"property": "PROPERTY", "domain": "DOMAIN", "option_set": "RANGE", "value": "VALUE", "qualifier": "QUALIFIER"}


def enumerate_cards(properties: DataFrame, classes: DataFrame, option_values: DataFrame, qualifiers: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """-> cards (card, tier, address), edges (card, slot, base), skips (property, at, reason).
    A card's id is its address; an address that is reached twice is one card. Skipped, and
    said so: properties without a domain, domains that are no class, option sets without
    values; ranges that are neither a class nor an option set."""
    known = classes.select(F.col("id").alias("domain")).distinct().withColumn("is_class", F.lit(True))
    rows = properties.select("property", F.explode_outer(F.array_distinct("domains")).alias("domain"), "ranges").join(known, "domain", "left")
    rows = stored(rows, "placed")
    no_domain = rows.where("domain is null").select("property", F.lit(None).cast("string").alias("at"), F.lit("no domain").alias("reason"))
    stray = rows.where("domain is not null and is_class is null").select("property", F.col("domain").alias("at"), F.lit("a domain that is no class").alias("reason"))
    placed = rows.where("is_class").select("property", "domain", "ranges")
    sets = option_values.select("option_set", "value").distinct()
    has = sets.groupBy("option_set").agg(F.count("value").alias("values"))
    ranged = properties.select("property", F.explode(F.array_distinct("ranges")).alias("option_set")).join(has, "option_set", "left")
    ranged = ranged.join(known.select(F.col("domain").alias("option_set"), "is_class"), "option_set", "left")
    empty = ranged.where("values = 0").select("property", F.col("option_set").alias("at"), F.lit("an option set without values").alias("reason"))
    unknown = ranged.where("values is null and is_class is null").select("property", F.col("option_set").alias("at"), F.lit("a range that is nothing known").alias("reason"))

    none = lambda name: F.lit(None).cast("string").alias(name)
    plain = placed.select("property", "domain", none("option_set"), none("value"))
    valued = placed.select("property", "domain", F.explode(F.array_distinct("ranges")).alias("option_set"))
    valued = valued.join(sets.where("value is not null"), "option_set").select("property", "domain", "option_set", "value")
    both = plain.unionByName(valued)
    qualified = both.join(qualifiers.select("property", "qualifier").distinct(), "property")
    cards = both.withColumn("qualifier", F.lit(None).cast("string")).unionByName(qualified.select(*ADDRESS)).distinct()
    tier = F.when(F.col("value").isNull(), PROPERTY_TIER).otherwise(VALUE_TIER)
    cards = cards.select(S.address_signature(*[F.col(c) for c in ADDRESS]).alias("card"), tier.alias("tier"), *ADDRESS)
    slots = F.array(*[F.struct(F.lit(s).alias("slot"), F.col(c).alias("base")) for c, s in SLOTS.items()])
    edges = cards.select("card", F.explode(slots).alias("x")).select("card", "x.*").where("base is not null")
    return cards, edges, no_domain.unionByName(stray).unionByName(empty).unionByName(unknown).distinct()


def domain_disagreements(properties: DataFrame, edges: DataFrame) -> DataFrame:
    """What properties say of their domains against HAS_PROPERTY edges (from_id, to_id):
    property, domain, side: only said, or only drawn."""
    said = properties.select("property", F.explode("domains").alias("domain")).distinct()
    drawn = edges.select(F.col("to_id").alias("property"), F.col("from_id").alias("domain")).distinct()
    a = said.join(drawn, ["property", "domain"], "left_anti").withColumn("side", F.lit("only said"))
    return a.unionByName(drawn.join(said, ["property", "domain"], "left_anti").withColumn("side", F.lit("only drawn")))
