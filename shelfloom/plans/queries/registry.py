"""Where the query modules register what they offer."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfloom.sources.tables import read_spread

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"two queries named {name}")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def load_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page table, spread for parsing."""
    return read_spread(spark, f"{sf_dir}/pages.parquet")


def load_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part table, spread before pages are rendered from it."""
    return read_spread(spark, f"{sf_dir}/part.parquet", narrow=True)
