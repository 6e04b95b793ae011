"""Database tables and other external stores, reached by options the caller gives."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    props: Mapping[str, str] | None = None,
    partition_column: str | None = None,
    bounds: tuple | None = None,
    num_partitions: int | None = None,
    fetch_rows: int = 10_000,
) -> DataFrame:
    """A database table; filters and columns are pushed to the database.

    With a ``partition_column`` its ``bounds`` are cut into ``num_partitions`` parallel queries;
    rows outside the bounds are read too.
    """
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_rows), **dict(props or {})}
    options |= _split_options(partition_column, bounds, num_partitions)
    return spark.read.format("jdbc").options(**options).load()


def _split_options(partition_column, bounds, num_partitions) -> dict[str, str]:
    if partition_column is None:
        return {}
    if bounds is None or num_partitions is None:
        raise ValueError("a partition column needs bounds and num_partitions")
    return {
        "partitionColumn": partition_column,
        "lowerBound": str(bounds[0]),
        "upperBound": str(bounds[1]),
        "numPartitions": str(num_partitions),
    }


def read_jdbc_query(
    spark: SparkSession, url: str, query: str, props: Mapping[str, str] | None = None, fetch_rows: int = 10_000
) -> DataFrame:
    """The result of a query the database runs, read over one connection: meant for small results."""
    options = {"url": url, "query": query, "fetchsize": str(fetch_rows), **dict(props or {})}
    return spark.read.format("jdbc").options(**options).load()


def jdbc_bounds(spark: SparkSession, url: str, table: str, column: str, props=None) -> tuple:
    """Smallest and largest value of a column, found by the database, for ``read_jdbc``."""
    query = f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}"
    return tuple(read_jdbc_query(spark, url, query, props).first())


def read_external(spark: SparkSession, fmt: str, options: Mapping[str, str]) -> DataFrame:
    """Any store with a Spark connector, such as a keyed store."""
    return spark.read.format(fmt).options(**dict(options)).load()
