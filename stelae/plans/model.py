"""The driver tables seen as the engine's model: nodes, edges, manifests, decisions.

``GRAPH_SQL`` states the same model as common table expressions for the oracle."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stelae.runtime import read_table


class Tables:
    """Input tables by name, read when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        table = self.__dict__[name] = read_table(self.spark, self.sf_dir, name)
        return table


def _id(kind: str, key) -> F.Column:
    return F.concat(F.lit(f"{kind}:"), F.col(key).cast("string"))


NODE_TABLES = (  # table, kind, key, name, source, role
    ("region", "region", "r_regionkey", "r_name", "geo", "root"),
    ("nation", "nation", "n_nationkey", "n_name", "geo", "class"),
    ("customer", "customer", "c_custkey", "c_name", "crm", "property"),
    ("supplier", "supplier", "s_suppkey", "s_name", "scm", "property"),
    ("part", "part", "p_partkey", "p_name", "cat", "optionValue"),
)
EDGE_TABLES = (  # table, type, from kind, from key, to kind, to key
    ("nation", "HAS_CLASS", "region", "n_regionkey", "nation", "n_nationkey"),
    ("customer", "HAS_PROPERTY", "nation", "c_nationkey", "customer", "c_custkey"),
    ("supplier", "HAS_PROPERTY", "nation", "s_nationkey", "supplier", "s_suppkey"),
)


def nodes(t: Tables) -> DataFrame:
    parts = [
        getattr(t, table).select(
            _id(kind, key).alias("stable_id"), F.lit(source).alias("source"), F.lit(role).alias("role"), F.col(name).alias("name")
        )
        for table, kind, key, name, source, role in NODE_TABLES
    ]
    return reduce(DataFrame.unionByName, parts)


def edges(t: Tables) -> DataFrame:
    parts = [
        getattr(t, table).select(F.lit(kind).alias("type"), _id(a, a_key).alias("from_id"), _id(b, b_key).alias("to_id"))
        for table, kind, a, a_key, b, b_key in EDGE_TABLES
    ]
    supplied = t.lineitem.select(
        F.lit("REFERENCES").alias("type"), _id("supplier", "l_suppkey").alias("from_id"), _id("part", "l_partkey").alias("to_id")
    )
    return reduce(DataFrame.unionByName, [*parts, supplied.distinct()])


GRAPH_SQL = (
    "WITH RECURSIVE nodes AS ("
    + " UNION ALL ".join(
        f"SELECT '{kind}:' || {key} AS stable_id, '{source}' AS source, '{role}' AS role, {name} AS name FROM {table}"
        for table, kind, key, name, source, role in NODE_TABLES
    )
    + "), edges AS ("
    + " UNION ALL ".join(
        f"SELECT '{kind}' AS type, '{a}:' || {ak} AS from_id, '{b}:' || {bk} AS to_id FROM {table}"
        for table, kind, a, ak, b, bk in EDGE_TABLES
    )
    + " UNION ALL SELECT DISTINCT 'REFERENCES', 'supplier:' || l_suppkey, 'part:' || l_partkey FROM lineitem)"
)
