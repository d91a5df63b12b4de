"""Queries by name with their SQL, and reading of the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sql(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """Run SQL in which ``{orders}`` and so on stand for the given tables."""
    return spark.sql(text.format(**{t: f"parquet.`{sf_dir}/{t}.parquet`" for t in TABLES}))


def duck(text: str) -> str:
    """The same SQL for an engine that has the tables as views."""
    return text.format(**{t: t for t in TABLES})
