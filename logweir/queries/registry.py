"""Named queries over the test tables, each with the SQL it must agree with where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from logweir.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The Parquet tables of a folder, by attribute."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def scratch(self, label: str) -> str:
        return scratch_path(self.spark, label)


def query(sql: str | None = None, name: str | None = None) -> Callable:
    """Register a function of ``Tables``, under its own name unless another is given."""

    def register(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        key = name or fn.__name__
        if key in QUERIES:
            raise ValueError(f"two queries named {key}")
        QUERIES[key] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return register
