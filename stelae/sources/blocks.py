"""PG-JSONL blocks: a header line, then node and edge lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stelae.runtime import stored

LINE = (
    "kind string, ref struct<source:string,id:string>, labels array<string>, stableId string, "
    "properties map<string,array<string>>, type string, fromRef struct<source:string,id:string>, toRef struct<source:string,id:string>"
)


def write_block(header: DataFrame, nodes: DataFrame, edges: DataFrame, path: str) -> None:
    """One JSON object a line: kind first, then the record's own fields. The header goes
    to ``path/header``, nodes and edges to ``path/lines`` in as many files as Spark has
    partitions."""
    header.select(F.to_json(F.struct(F.lit("header").alias("kind"), *header.columns))).write.text(f"{path}/header")
    lines = nodes.select(F.to_json(F.struct(F.lit("node").alias("kind"), *nodes.columns)).alias("value"))
    more = edges.select(F.to_json(F.struct(F.lit("edge").alias("kind"), *edges.columns)).alias("value"))
    lines.unionByName(more).write.text(f"{path}/lines")


def read_block(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges). A line that isn't a node or an edge fails the read."""
    lines = spark.read.text(f"{path}/lines").select(F.from_json("value", LINE).alias("x"), "value").select("x.*", "value")
    known = F.col("kind").isin("node", "edge")
    lines = lines.withColumn("kind", F.when(known, F.col("kind")).otherwise(F.raise_error(F.concat(F.lit("not a block line: "), "value"))))
    nodes = lines.where("kind = 'node'").select("ref", "labels", "stableId", "properties")
    return nodes, lines.where("kind = 'edge'").select("type", "fromRef", "toRef", "properties")


def read_log(spark: SparkSession, path: str, schema: str, strict: bool = True) -> DataFrame:
    """A JSONL log. strict: a line that doesn't parse fails the read; else such lines
    stay, in the column ``malformed``."""
    if strict:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    kept = spark.read.schema(schema + ", malformed string").option("columnNameOfCorruptRecord", "malformed").json(path)
    return stored(kept, "log")


def put_once(table: DataFrame, new: DataFrame, key: str, content: str, order: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Content-addressed append: (rows to add, rows refused because their key is held
    with other content). The first write of a key wins: what the table holds, else the
    row of least ``order``, beside which other contents of the batch are refused; those
    that tie for the first place are all refused. Without ``order`` the batch's least
    content stands for its key."""
    held = table.select(key, F.col(content).alias("held"))
    if order is None:
        first = new.groupBy(key).agg(F.min(content).alias(content))
        fresh = first.join(held, key, "left_anti")
        return fresh, first.join(held, key).where(F.col(content) != F.col("held")).select(key, content)
    rows = new.groupBy(key, content).agg(F.min(order).alias("place"))
    least = rows.groupBy(key).agg(F.min("place").alias("place"))
    first = rows.join(least, [key, "place"]).groupBy(key).agg(F.min(content).alias("held"), F.count(F.lit(1)).alias("n"))
    first = first.join(table.select(key), key, "left_anti")
    fresh = first.where("n = 1").select(key, F.col("held").alias(content))
    kept = held.unionByName(first.select(key, F.when(F.col("n") == 1, F.col("held")).alias("held")))
    refused = rows.join(kept, key).where(~F.col(content).eqNullSafe(F.col("held")))
    return fresh, refused.select(key, content)


def checksum_failures(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """manifest (path, sha256): listed files that are absent or differ."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    name = F.element_at(F.split("path", "/"), -1)
    found = files.select(name.alias("path"), F.sha2("content", 256).alias("actual"))
    return manifest.join(found, "path", "left").where(F.col("actual").isNull() | (F.col("actual") != F.col("sha256")))
