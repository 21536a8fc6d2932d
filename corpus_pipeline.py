"""The corpus pipeline: ``documents`` becomes packed training sequences.

Stages, in order: documents of low quality go, toxic documents go, one document of
each near-duplicate group stays, byte strings that an earlier document has are cut,
and what is left is packed. Each stage gets what its predecessor wrote; all but the
last return the columns of ``documents``, with ``n_chars`` brought up to date where
the text changed.

Defined results: null and empty texts are judged like any other text (near duplicates
of each other, one piece of one token in the end); texts of any length are read whole;
rows are told apart by id and text, so copies of one id leave one row and different
texts of one id stay; of a group the row with the smallest id stays, null ids come
last; tables without rows or without labels give what is left (nothing, or all rows
unjudged); further columns are dropped.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stelae.llm import packing, quality, simhash, suffix_dedup, toxicity
from stelae.runtime import read_table, stored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
LEAST_QUALITY, MOST_TOXICITY = 0.3, 0.5


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.train(docs, read_table(spark, sf_dir, "labels"))
    return quality.score(docs.select(*COLUMNS), model).where(F.col("score") >= LEAST_QUALITY).select(*COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.score(docs.select(*COLUMNS), model).where(F.col("score") < MOST_TOXICITY).select(*COLUMNS)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows are told apart by id and text, so different texts of one id stay."""
    key = F.struct(
        F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("id"),
        F.xxhash64("text").alias("one"),
        F.xxhash64(F.lit(1), "text").alias("two"),
    )
    rows = docs.select(*COLUMNS, key.alias("row"))
    groups = stored(simhash.near_duplicates(rows, "row").groupBy("row").agg(F.min("component_id").alias("first"), F.count(F.lit(1)).alias("times")), "groups")
    kept = rows.join(groups.where(F.col("row") != F.col("first")).select("row"), "row", "left_anti")
    again = groups.where((F.col("row") == F.col("first")) & (F.col("times") > 1)).select("row")
    if again.limit(1).count():  # rows with the same id and text: one of them stays
        kept = kept.join(again, "row", "left_anti").unionByName(kept.join(again, "row", "left_semi").dropDuplicates(["row"]))
    return kept.select(*COLUMNS)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # A cut may fall inside a character; what is left of it goes.
    out = suffix_dedup.remove_repeats(docs, ("lang", "source"), whole_characters=True)
    out = out.withColumn("text", F.expr("make_valid_utf8(cast(kept as string))")).withColumn("n_chars", F.length("text").cast("long"))
    return out.select(*COLUMNS)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(packing.token_pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("quality_classifier", keep_quality),
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", one_of_each_group),
    ("suffix_array_dedup", cut_repeats),
    ("best_fit_packing", pack_documents),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
