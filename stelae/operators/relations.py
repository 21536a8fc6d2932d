"""Reads over the derived rows, each for all its keys at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def versions_for_standards(members: DataFrame, standards: DataFrame) -> DataFrame:
    """members (layer, version_tag, pair_key: ``hub@release::standard@version::...``),
    standards (layer, standard, standard_key) -> standard, standard_version, layer,
    version_tag: the layer versions that hold a block of the standard's version."""
    side = F.get(F.split("pair_key", "::"), 1)
    cut = members.select("layer", "version_tag", F.substring_index(side, "@", 1).alias("standard_key"), F.substring_index(side, "@", -1).alias("standard_version"))
    found = cut.distinct().join(standards, ["layer", "standard_key"])
    return found.select("standard", "standard_version", "layer", "version_tag").distinct()


def manifest_standards(members: DataFrame, elements: DataFrame) -> DataFrame:
    """members (manifest, ref_id), elements (ref_id, standard, version, standard_key, ...)
    -> one row for each base block of a manifest, with its number of elements."""
    counted = elements.groupBy("ref_id", "standard", "version", "standard_key").agg(F.count(F.lit(1)).alias("elements"))
    return members.distinct().join(counted, "ref_id")


def domain_cards(members: DataFrame, cards: DataFrame, page: int, size: int) -> DataFrame:
    """One page of the cards of every domain of every manifest, by meaning; cards that
    several blocks hold count once; cards without a domain are on no page."""
    if page < 1 or not 1 <= size <= 1000:
        raise ValueError("pages are numbered from 1 and hold 1 to 1000 cards")
    columns = ["manifest", "hub", "release", "domain"]
    shown = [c for c in cards.columns if c not in ("ref_id", *columns)]
    whole = members.join(cards.where("domain is not null"), "ref_id").select(*columns, *shown).distinct()
    place = F.row_number().over(Window.partitionBy(*columns).orderBy("meaning", *[c for c in shown if c != "meaning"]))
    return whole.withColumn("place", place).where(F.col("place").between((page - 1) * size + 1, page * size))


def layer_list(versions: DataFrame, statuses: DataFrame) -> DataFrame:
    """versions (layer, version_tag, published), statuses (layer, version_tag, place,
    status) -> layer, versions, current: the latest published of the versions whose last
    status is ``standard``, or null."""
    last = statuses.groupBy("layer", "version_tag").agg(F.max_by("status", "place").alias("status"))
    held = versions.join(last, ["layer", "version_tag"], "left")
    current = F.max(F.when(F.col("status") == "standard", F.struct("published", "version_tag")))
    return held.groupBy("layer").agg(F.count(F.lit(1)).alias("versions"), current["version_tag"].alias("current"))


def first_assertions(assertions: DataFrame, asked: DataFrame) -> DataFrame:
    """asked (decision, assertion_id) -> the assertion of least ordinal for each."""
    held = assertions.join(asked.select("decision", "assertion_id").distinct(), ["decision", "assertion_id"])
    first = held.groupBy("decision", "assertion_id").agg(F.min("ordinal").alias("ordinal"))
    return held.join(first, ["decision", "assertion_id", "ordinal"], "left_semi")


def element_assertions(assertions: DataFrame, asked: DataFrame) -> DataFrame:
    """asked (decision, subject) -> all assertions of these elements."""
    return assertions.join(asked.select("decision", "subject").distinct(), ["decision", "subject"], "left_semi")
