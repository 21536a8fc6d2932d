"""Registered queries of the graph and mapping operators: each has a Spark plan and,
where SQL can state it, an independent oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stelae.plans.model import Tables

_QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of the tables under its own name."""

    def add(function):
        _QUERIES[function.__name__] = function
        if sql:
            _SQL[function.__name__] = sql
        return function

    return add


def _load() -> None:
    from stelae.plans import card_queries, derived_queries, document_queries, gate_queries, graph_queries, kit_queries, mapping_queries, relation_queries, source_queries, standards_queries, store_queries, structure_queries, text_queries, voting_queries  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return {name: (lambda spark, sf_dir, f=f: f(Tables(spark, sf_dir))) for name, f in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    _load()
    return _QUERIES["cosine_topk"](Tables(spark, sf_dir))
