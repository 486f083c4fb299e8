"""Register of (query, oracle SQL) pairs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import ship_package, spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The given tables of one folder, read on first use."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def spread(self, name: str, key: str) -> DataFrame:
        return spread(getattr(self, name), key)

    def sql(self, text: str, **frames: DataFrame) -> DataFrame:
        return self.spark.sql(text, **frames)


def query(name: str, oracle: str | None = None):
    """Register ``fn(tables)`` under ``name``, with the SQL that must give the same rows."""

    def add(fn):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Tables(ship_package(spark), folder))

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return add
