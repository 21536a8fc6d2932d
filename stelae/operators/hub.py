"""Hub, resolution and gate operators."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stelae.runtime import ship_package, stored


def freeze_votes(paths: DataFrame) -> DataFrame:
    """paths (subject, hit) -> subject, hits (each once, sorted), path_hits (an index into
    hits for every path)."""
    held = paths.groupBy("subject").agg(F.array_sort(F.collect_set("hit")).alias("hits"), F.collect_list("hit").alias("all"))
    return held.select("subject", "hits", F.transform("all", lambda h: F.array_position("hits", h)).alias("path_hits"))


def expand_votes(frozen: DataFrame) -> DataFrame:
    return frozen.select("subject", "hits", F.explode("path_hits").alias("i")).select(
        "subject", F.expr("element_at(hits, cast(i as int))").alias("hit")
    )


def resolve_subjects(subjects: DataFrame, leaves: DataFrame) -> DataFrame:
    """subjects (subject, target_set), leaves (subject, leaf) -> subject, leaf, verdict:
    sourceGap without a leaf, collision where subjects of one leaf differ in their target
    set, else resolved."""
    found = subjects.join(leaves, "subject", "left")
    sets = found.where("leaf is not null").groupBy("leaf").agg(F.countDistinct("target_set").alias("sets"))
    verdict = F.when(F.col("leaf").isNull(), "sourceGap").when(F.col("sets") > 1, "collision").otherwise("resolved")
    return found.join(sets, "leaf", "left").select("subject", "leaf", verdict.alias("verdict"))


def cross_reference_edges(records: DataFrame, universe: DataFrame) -> DataFrame:
    """records (id, cross_refs array<struct<raw, locator>>), universe (raw): references
    that the universe knows, each pair once, with its earliest locator."""
    refs = records.select(F.col("id").alias("from_id"), F.explode("cross_refs").alias("r")).select("from_id", "r.raw", "r.locator")
    known = refs.join(universe, "raw", "left_semi")
    return known.groupBy("from_id", F.col("raw").alias("to_id")).agg(F.min("locator").alias("locator"))


def missing_properties(nodes: DataFrame, role: str, required: list[str]) -> DataFrame:
    """Nodes of each role that lack any required property."""
    lacking = F.lit(False)
    for name in required:
        lacking = lacking | F.col(name).isNull()
    return nodes.where(lacking).groupBy(role).agg(F.count(F.lit(1)).alias("violations"))


def capped_lists(rows: DataFrame, group: str, value: str, most: int) -> DataFrame:
    """The first values of each group as text, and how many more there are."""
    each = rows.select(group, value).distinct()
    # The limit is applied in each task before the shuffle, so no group is gathered.
    place = F.row_number().over(Window.partitionBy(group).orderBy(F.col(value).asc_nulls_last()))
    shown = each.withColumn("place", place).where(F.col("place") <= most)
    shown = shown.groupBy(group).agg(F.array_sort(F.collect_list(value)).alias("v"))
    held = each.groupBy(group).agg(F.count(value).alias("n")).join(shown, group)
    text = F.array_join(F.col("v").cast("array<string>"), ",")
    more = F.when(F.col("n") > most, F.concat(F.lit(" +"), (F.col("n") - most).cast("string"), F.lit(" more"))).otherwise("")
    return held.select(group, F.concat(text, more).alias("sample"))


def chain_depths(parents: DataFrame, most_rounds: int = 40) -> DataFrame:
    """parents (id, parent or null) -> id, depth, root: pointer doubling, so rounds grow
    with the logarithm of the longest chain; a cycle raises."""
    state = parents.select("id", F.col("parent").alias("up"), F.when(F.col("parent").isNull(), 0).otherwise(1).alias("depth"))
    state = stored(state, "chain")
    for _ in range(most_rounds):
        if not state.where("up is not null").limit(1).count():
            return state.select("id", "depth")
        above = state.select(F.col("id").alias("up"), F.col("up").alias("next"), F.col("depth").alias("more"))
        step = state.join(above, "up", "left")
        depth = F.col("depth") + F.coalesce("more", F.lit(0))
        state = stored(step.select("id", F.col("next").alias("up"), depth.alias("depth")), "chain")
    raise ValueError("the parents form a cycle")


def guarded_paths(edges: DataFrame, roots: DataFrame, most: int) -> DataFrame:
    """Every path from the roots that visits no node twice, up to ``most`` nodes."""
    found = roots.select(F.array("stable_id").alias("path"))
    layer = found
    for _ in range(most - 1):
        tail = layer.withColumn("from_id", F.element_at("path", -1)).join(edges, "from_id")
        layer = tail.where(~F.array_contains("path", F.col("to_id"))).select(F.array_append("path", F.col("to_id")).alias("path"))
        found = found.unionByName(layer)
    return found


def encoded_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding -> base64 of little-endian floats, and the width read back."""
    ship_package(vectors.sparkSession)

    @F.arrow_udf("binary")
    def encode(column: pa.Array) -> pa.Array:
        # The lists' flat values are the bytes; only the offsets are counted anew.
        flat = column.flatten().cast(pa.float32()).to_numpy(zero_copy_only=False).astype("<f4")
        sizes = pyarrow.compute.fill_null(pyarrow.compute.list_value_length(column), 0).to_numpy(zero_copy_only=False)
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32) * 4
        raw = pa.Array.from_buffers(pa.binary(), len(column), [None, pa.py_buffer(offsets.astype("<i4").tobytes()), pa.py_buffer(flat.tobytes())])
        return pyarrow.compute.if_else(column.is_null(), pa.scalar(None, pa.binary()), raw)

    rows = vectors.select("vec_id", F.base64(encode("embedding")).alias("encoded"))
    return rows.withColumn("width", (F.length(F.unbase64("encoded")) / 4).cast("int"))


def decoded_vectors(rows: DataFrame) -> DataFrame:
    """vec_id, encoded -> the same with ``vector``, read back from its bytes."""

    @F.arrow_udf("array<float>")
    def decode(column: pa.Array) -> pa.Array:
        sizes = pyarrow.compute.fill_null(pyarrow.compute.binary_length(column), 0).to_numpy(zero_copy_only=False)
        flat = np.frombuffer(b"".join(x.as_py() or b"" for x in column), "<f4")
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes // 4)]).astype(np.int32))
        return pa.ListArray.from_arrays(offsets, pa.array(flat, pa.float32()), mask=column.is_null())

    return rows.withColumn("vector", decode(F.unbase64("encoded")))


def merged_sums(maps: Column) -> Column:
    """An array of map<string, bigint> as one map; values of one key are added."""
    add = lambda k, a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))
    return F.aggregate(maps, F.create_map().cast("map<string,bigint>"), lambda acc, m: F.map_zip_with(acc, m, add))
