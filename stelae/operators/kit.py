"""Minting nodes and edges of a standard under the kit's rules. What breaks a rule is
refused by name, in rows of its own; nothing is repaired, and nothing is lost silently."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stelae.functions import scalars as S

FORGED = "ForgedNode"  # fixed value
#: Properties that the kit itself gives to every node.
UNIVERSAL = ("_id", "_source", "name", "role", "searchText", "parentId", "path")
TIER = ("provenanceTier", "structural")


@dataclass(frozen=True)
class Kit:
    """roles that nodes may have; those without search text; what an id looks like;
    properties in which an empty text is allowed; edge types; types that stand for native
    ones; types that are written no more."""

    source: str
    label: str
    roles: tuple[str, ...]
    edge_types: tuple[str, ...]
    silent_roles: tuple[str, ...] = ()
    id_pattern: str = r"^[^\s]+$"
    may_be_empty: tuple[str, ...] = ()
    substitutes: tuple[tuple[str, str], ...] = ()
    retired: tuple[str, ...] = ()


def _reasons(*rules: tuple[Column, str]) -> Column:
    return F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(text)) for c, text in rules]))


def mint_nodes(rows: DataFrame, kit: Kit) -> tuple[DataFrame, DataFrame]:
    """rows (stable_id, role, name, description, parent, path, owner, carried: map of lists,
    origin) -> nodes (stable_id, labels, role, properties), refused (stable_id, reason,
    origin). Of rows that share an id none is taken. Absent names and descriptions are
    left out; empty ones are refused where they aren't allowed."""
    again = rows.groupBy("stable_id").agg(F.count(F.lit(1)).alias("times")).where("times > 1")
    held = rows.join(again, "stable_id", "left")
    names = F.map_keys(F.coalesce("carried", F.create_map().cast("map<string,array<string>>")))
    taken = F.array(*[F.lit(n) for n in UNIVERSAL])
    clash = F.arrays_overlap(names, taken) | (F.col("description").isNotNull() & F.array_contains(names, "description"))
    empty = lambda c: (F.col(c) == "") & F.lit(c not in kit.may_be_empty)
    reasons = _reasons(
        (~F.col("role").isin(*kit.roles) | F.col("role").isNull(), "an unknown role"),
        (F.col("stable_id").isNull() | ~F.col("stable_id").rlike(kit.id_pattern), "an unclean id"),
        (F.col("times").isNotNull(), "an id minted twice"), (clash, "a carried name that is the kit's"),
        (empty("name"), "an empty name"), (empty("description"), "an empty description"),
    )
    held = held.withColumn("reasons", reasons)
    refused = held.select("stable_id", F.explode("reasons").alias("reason"), "origin")
    good = held.where("size(reasons) = 0")
    one = lambda name, value: F.when(value.isNotNull(), F.struct(F.lit(name).alias("key"), F.array(value).alias("value")))
    name, role = F.col("name"), F.col("role")
    search = S.search_text(role, name, F.coalesce("owner", F.lit(kit.source)))
    given = F.array_compact(F.array(
        one("_id", F.col("stable_id")), one("_source", F.lit(kit.source)), one("name", name), one("role", role),
        one("searchText", F.when(~role.isin(*kit.silent_roles) if kit.silent_roles else F.lit(True), search)),
        one("parentId", F.col("parent")), one("path", F.col("path")), one("description", F.col("description")),
    ))
    carried = F.coalesce(F.map_entries("carried"), F.array().cast("array<struct<key:string,value:array<string>>>"))
    labels = F.array(F.lit(FORGED), F.lit(kit.label), role).alias("labels")
    nodes = good.select("stable_id", labels, "role", F.map_from_entries(F.concat(given, carried)).alias("properties"))
    return nodes, refused


def mint_edges(rows: DataFrame, nodes: DataFrame, kit: Kit) -> tuple[DataFrame, DataFrame, DataFrame]:
    """rows (type, from_id, to_id, context, properties) -> edges (type, from_id, to_id,
    properties), refused (type, reason, context), dangling (type, from_id, to_id, context): an
    end that is absent, or that no node of the kit has. Native types become those that
    stand for them; the caller's properties win over the kit's."""
    stands = F.lit(None).cast("string")
    for native, meant in kit.substitutes:
        stands = F.when(F.col("type") == native, meant).otherwise(stands)
    kind = F.when(F.col("type").isin(*kit.edge_types), F.col("type")).otherwise(stands)
    gone = F.col("type").isin(*kit.retired) if kit.retired else F.lit(False)
    reasons = _reasons((gone, "a retired type"), (~F.coalesce(gone, F.lit(False)) & (kind.isNull() | ~kind.isin(*kit.edge_types)), "a type of no registry"))
    held = rows.withColumns({"kind": kind, "reasons": reasons})
    refused = held.select("type", F.explode("reasons").alias("reason"), "context")
    good = held.where("size(reasons) = 0")
    for end in ("from", "to"):
        good = good.join(nodes.select(F.col("stable_id").alias(f"{end}_id"), F.lit(True).alias(f"has_{end}")), f"{end}_id", "left")
    whole = F.col("has_from").isNotNull() & F.col("has_to").isNotNull()
    dangling = good.where(~whole).select(F.col("kind").alias("type"), "from_id", "to_id", "context")
    own = F.map_filter(F.create_map(F.lit(TIER[0]), F.array(F.lit(TIER[1]))), lambda k, _: ~F.coalesce(F.map_contains_key("properties", k), F.lit(False)))
    properties = F.map_concat(own, F.coalesce("properties", F.create_map().cast("map<string,array<string>>")))
    return good.where(whole).select(F.col("kind").alias("type"), "from_id", "to_id", properties.alias("properties")), refused, dangling


def unwrapped(properties: Column, lists: tuple[str, ...], integers: tuple[str, ...]) -> Column:
    """A map of lists as a map of JSON texts, as stored: a list of one is its member,
    unless its name is declared a list; declared integers are numbers (others fail the
    job)."""
    names = lambda x: F.array(*[F.lit(n) for n in x]) if x else F.array().cast("array<string>")

    def one(name: Column, value: Column) -> Column:
        number = F.when(value.rlike("^-?[0-9]+$"), value.cast("decimal(38,0)").cast("string"))
        number = F.coalesce(number, F.raise_error(F.concat(F.lit("no integer in "), name, F.lit(": "), F.coalesce(value, F.lit("null")))).cast("string"))
        text = F.to_json(F.array(value))
        quoted = F.when(value.isNull(), F.lit("null")).otherwise(F.substr(text, F.lit(2), F.length(text) - 2))
        return F.when(F.array_contains(names(integers), name), number).otherwise(quoted)

    def whole(name: Column, values: Column) -> Column:
        each = F.transform(values, lambda v: one(name, v))
        single = (F.size(values) == 1) & ~F.array_contains(names(lists), name)
        return F.when(single, F.get(each, 0)).otherwise(F.concat(F.lit("["), F.array_join(each, ","), F.lit("]")))

    return F.transform_values(properties, whole)
