"""Set, bag and record comparison, and fingerprints of tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def diff_sets(golden: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """key, side: missing (only in golden) or extra (only in new)."""
    a, b = golden.select(key).distinct(), new.select(key).distinct()
    missing = a.join(b, key, "left_anti").withColumn("side", F.lit("missing"))
    return missing.unionByName(b.join(a, key, "left_anti").withColumn("side", F.lit("extra")))


def bag_surplus(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys that a holds more often than b, and by how many."""
    counts = [x.groupBy(key).agg(F.count(F.lit(1)).alias(n)) for x, n in ((a, "in_a"), (b, "in_b"))]
    both = counts[0].join(counts[1], key, "left")
    return both.select(key, (F.col("in_a") - F.coalesce("in_b", F.lit(0))).alias("surplus")).where("surplus > 0")


def compare_records(a: DataFrame, b: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """key, verdict: only_in_a, only_in_b, changed or same, by a digest of the columns."""
    digest = record_hash([F.col(c) for c in columns])
    left, right = a.select(key, digest.alias("in_a")), b.select(key, digest.alias("in_b"))
    verdict = (
        F.when(F.col("in_b").isNull(), "only_in_a")
        .when(F.col("in_a").isNull(), "only_in_b")
        .when(F.col("in_a") != F.col("in_b"), "changed")
        .otherwise("same")
    )
    return left.join(right, key, "full").select(key, verdict.alias("verdict"))


def record_hash(columns: list[Column]) -> Column:
    """SHA-256 of the values in order, joined by U+001F; null is U+0000. Where a value holds
    one of these, or U+001E, it is written as U+001E and a letter, so that no two lists of
    values make one text."""

    def plain(c: Column) -> Column:
        text = c.cast("string")
        for held, letter in (("\u001e", "e"), ("\u001f", "s"), ("\u0000", "n")):
            text = F.replace(text, F.lit(held), F.lit("\u001e" + letter))
        return F.coalesce(text, F.lit("\u0000"))

    return F.sha2(F.concat_ws("\u001f", *map(plain, columns)), 256)


def statement_diff(source: DataFrame, graph: DataFrame, omitted: DataFrame) -> DataFrame:
    """statement, verdict: matched, invented (graph only), omitted (declared) or lost."""
    a = source.select("statement").distinct().withColumn("in_source", F.lit(True))
    b = graph.select("statement").distinct().withColumn("in_graph", F.lit(True))
    c = omitted.select("statement").distinct().withColumn("declared", F.lit(True))
    rows = a.join(b, "statement", "full").join(c, "statement", "left")
    verdict = (
        F.when(F.col("in_source") & F.col("in_graph"), "matched")
        .when(F.col("in_graph"), "invented")
        .when(F.col("declared"), "omitted")
        .otherwise("lost")
    )
    return rows.select("statement", verdict.alias("verdict"))


def table_fingerprint(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Rows, distinct rows and an order-free digest of every row hash: for each leading
    byte of the hashes, rows, distinct rows, least and greatest hash and, where there
    are more than two rows, the sums of the hashes' eight 32-bit parts (up to 2^31 rows
    a byte). Two rows are told by least and greatest alone. Grows with no group."""
    digest = record_hash([F.col(c) for c in columns])
    hashed = rows.select(digest.alias("h"))
    parts = [F.sum(F.conv(F.substring("h", 8 * i + 1, 8), 16, 10).cast("long")).cast("string") for i in range(8)]
    by = hashed.groupBy(F.substring("h", 1, 2).alias("lead")).agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("h").alias("d"), F.min("h").alias("low"), F.max("h").alias("high"),
        F.concat_ws(":", *parts).alias("sums"),
    )
    part = F.concat_ws(":", "lead", F.col("n").cast("string"), F.col("d").cast("string"), "low", "high", F.when(F.col("n") > 2, F.col("sums")))
    return by.agg(
        F.sum("n").alias("n_rows"),
        F.sum("d").alias("n_distinct"),
        F.sha2(F.array_join(F.array_sort(F.collect_list(part)), "\n"), 256).alias("fingerprint"),
    )


def contains_all(members: DataFrame, sets: DataFrame, group: str, key: str) -> DataFrame:
    """Relational division: the (set, group) pairs whose group holds every key of the
    set. members (group, key), sets (set, key)."""
    size = sets.groupBy("set").agg(F.countDistinct(key).alias("size"))
    held = members.select(group, key).distinct().join(sets.select("set", key).distinct(), key)
    held = held.groupBy("set", group).agg(F.count(F.lit(1)).alias("held"))
    return held.join(size, "set").where("held = size").select("set", group)


def compare_graphs(golden_nodes: DataFrame, new_nodes: DataFrame, golden_edges: DataFrame, new_edges: DataFrame, key: str) -> DataFrame:
    """what (nodes or edges), key, side for all that differs between two graphs; no rows
    where they are the same. An absent side is a fault, not an empty comparison."""
    sides = {"golden_nodes": golden_nodes, "new_nodes": new_nodes, "golden_edges": golden_edges, "new_edges": new_edges}
    absent = [name for name, rows in sides.items() if rows is None]
    if absent:
        raise ValueError(f"nothing to compare: {absent}")
    nodes = diff_sets(golden_nodes, new_nodes, key).withColumn("what", F.lit("nodes"))
    return nodes.unionByName(diff_sets(golden_edges, new_edges, key).withColumn("what", F.lit("edges"))).select("what", key, "side")


def compare_blocks(baseline: DataFrame, candidate: DataFrame, fields: list[str]) -> DataFrame:
    """Latest blocks of two stores (pair, text, fingerprint, and header fields) -> pair, verdict,
    differing: BASELINE_ONLY, CANDIDATE_ONLY, IDENTICAL, ONLY_FINGERPRINT_DIFFERS (the text is
    the same once the fingerprint is), or DIFFERENT with the names of the header fields that
    differ, or ``body`` where none does."""
    sides = [x.select("pair", F.struct("text", "fingerprint", *fields).alias(n)) for x, n in ((baseline, "a"), (candidate, "b"))]
    both = sides[0].join(sides[1], "pair", "full")
    same = F.replace(F.col("b.text"), F.col("b.fingerprint"), F.col("a.fingerprint")) == F.col("a.text")
    verdict = F.when(F.col("a").isNull(), "CANDIDATE_ONLY").when(F.col("b").isNull(), "BASELINE_ONLY").when(F.col("a.text") == F.col("b.text"), "IDENTICAL")
    verdict = verdict.when(same, "ONLY_FINGERPRINT_DIFFERS").otherwise("DIFFERENT")
    names = F.array_sort(F.array_compact(F.array(*[F.when(~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")), F.lit(c)) for c in fields])))
    names = F.when(F.size(names) > 0, names).otherwise(F.array(F.lit("body")))
    found = both.select("pair", verdict.alias("verdict"), names.alias("names"))
    return found.select("pair", "verdict", F.when(F.col("verdict") == "DIFFERENT", F.col("names")).alias("differing"))


def typed_value(column: Column, kind) -> Column:
    """A value as JSON text that tells its type: the integer 1, the float 1.0 and the text
    "1" differ, as do -0.0 and 0.0; lists keep their order, maps are sorted by key. kind: the
    column's data type."""
    from pyspark.sql import types as T

    quoted = lambda c: F.regexp_replace(F.to_json(F.array(c)), r"^\[|\]$", "")
    tag = lambda name, c: F.concat(F.lit(f'["{name}",'), c, F.lit("]"))
    if isinstance(kind, T.StringType):
        made = tag("str", quoted(column))
    elif isinstance(kind, T.BooleanType):
        made = tag("bool", column.cast("string"))
    elif isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        made = tag("int", quoted(column.cast("string")))
    elif isinstance(kind, (T.FloatType, T.DoubleType)):
        made = tag("float", quoted(column.cast("double").cast("string")))
    elif isinstance(kind, T.BinaryType):
        made = tag("bytes", quoted(F.lower(F.hex(column))))
    elif isinstance(kind, T.ArrayType):
        made = tag("list", F.concat(F.lit("["), F.array_join(F.transform(column, lambda x: typed_value(x, kind.elementType)), ","), F.lit("]")))
    elif isinstance(kind, T.MapType):
        each = F.transform(F.array_sort(F.map_entries(column)), lambda e: F.concat(F.lit("["), quoted(e["key"]), F.lit(","), typed_value(e["value"], kind.valueType), F.lit("]")))
        made = tag("map", F.concat(F.lit("["), F.array_join(each, ","), F.lit("]")))
    elif isinstance(kind, T.StructType):
        each = [F.concat(F.lit(f'["{f.name}",'), typed_value(column[f.name], f.dataType), F.lit("]")) for f in sorted(kind.fields, key=lambda f: f.name)]
        made = tag("map", F.concat(F.lit("["), F.concat_ws(",", *each), F.lit("]")))
    else:
        made = tag(kind.simpleString(), quoted(column.cast("string")))
    return F.when(column.isNull(), F.lit('["null"]')).otherwise(made)


def set_digest(hashes: DataFrame, hash_col: str, lead: int = 3) -> DataFrame:
    """n and digest of a bag of hex hashes, whatever their order: the sorted hashes of each
    leading part are digested, then the sorted digests of these. A part is as many times
    smaller than the whole as there are parts (16 to the power of ``lead``)."""
    own = hashes.select(F.substring(hash_col, 1, lead).alias("part"), F.col(hash_col).alias("h"))
    parts = own.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sha2(F.array_join(F.array_sort(F.collect_list("h")), "\n"), 256).alias("d"))
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "d"))), lambda x: x["d"]), "\n")
    return parts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.sha2(whole, 256).alias("digest"))
