"""Tabular and marked-up sources: SSSOM, TSV, JSON-LD graphs, XML, HTML titles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_sssom(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(header as key, value; rows). Header lines begin with ``#``."""
    lines = spark.read.text(path).where(F.col("value").startswith("#"))
    pair = F.regexp_extract("value", r"^#\s*([^:]+):\s*(.*)$", 1), F.regexp_extract("value", r"^#\s*([^:]+):\s*(.*)$", 2)
    return lines.select(pair[0].alias("key"), pair[1].alias("value")), spark.read.csv(path, sep="\t", header=True, comment="#")


def write_tsv(rows: DataFrame, path: str) -> None:
    rows.write.csv(path, sep="\t", header=True)


def expand_curies(rows: DataFrame, column: str, prefixes: DataFrame) -> DataFrame:
    """prefix:local becomes an IRI; prefixes (prefix, base). Unknown ones give null."""
    cut = F.substring_index(column, ":", 1).alias("prefix")
    local = F.expr(f"substring({column}, instr({column}, ':') + 1)")
    joined = rows.select("*", cut).join(prefixes, "prefix", "left")
    return joined.withColumn("iri", F.concat("base", local)).drop("prefix", "base")


def json_ld_statements(documents: DataFrame) -> DataFrame:
    """documents (name, json): one row for each @graph entry and string property."""
    entries = documents.select("name", F.explode(F.from_json(F.get_json_object("json", "$.@graph"), "array<map<string,string>>")).alias("entry"))
    pairs = entries.select("name", F.col("entry")["@id"].alias("subject"), F.explode("entry").alias("predicate", "object"))
    return pairs.where("predicate <> '@id'")


def xml_values(rows: DataFrame, column: str, paths: dict[str, str]) -> DataFrame:
    return rows.select("*", *[F.xpath_string(F.col(column), F.lit(p)).alias(n) for n, p in paths.items()])


def html_title(html) -> F.Column:
    return F.regexp_extract(html, "(?s)<title>(.*?)</title>", 1)


def union_of_keys(lines: DataFrame) -> DataFrame:
    """JSON objects (one a row, in ``value``) as columns: the union of all keys."""
    maps = lines.select(F.from_json("value", "map<string,string>").alias("m"))
    keys = sorted(r["k"] for r in maps.select(F.explode(F.map_keys("m")).alias("k")).distinct().collect())  # a header's names
    return maps.select(*[F.try_element_at("m", F.lit(k)).alias(k) for k in keys])


def read_partition(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A two-column TSV with a header. A blank or repeated object fails the read."""
    rows = spark.read.csv(path, sep="\t", header=True, schema=schema)
    key = rows.columns[0]
    checked = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.first(rows.columns[1]).alias(rows.columns[1]))
    bad = F.col(key).isNull() | (F.col("n") > 1)
    return checked.select(F.when(bad, F.raise_error(F.lit(f"blank or repeated {key}"))).otherwise(F.col(key)).alias(key), rows.columns[1])
