"""Views, tables and schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def sql_over(df: DataFrame, name: str, sql: str) -> DataFrame:
    """Run SQL text over ``df`` under a view name."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.sql(sql)


def global_sql(df: DataFrame, name: str, sql: str) -> DataFrame:
    """Run SQL text over ``global_temp.name`` from a second session."""
    df.createOrReplaceGlobalTempView(name)
    return df.sparkSession.newSession().sql(sql)


def list_catalog(spark: SparkSession) -> DataFrame:
    """Tables, views and functions of the current database: columns ``kind``, ``name``."""
    tables = spark.sql("SHOW TABLES").select(F.lit("table").alias("kind"), F.col("tableName").alias("name"))
    functions = spark.sql("SHOW FUNCTIONS").select(F.lit("function").alias("kind"), F.col("function").alias("name"))
    return tables.union(functions)


def _shape(schema: StructType) -> list[tuple[str, str]]:
    return [(field.name, field.dataType.simpleString()) for field in schema]


def assert_schema(df: DataFrame, expected: StructType) -> DataFrame:
    """``df`` itself when its column names and types are as expected, else ``TypeError``."""
    if _shape(df.schema) != _shape(expected):
        raise TypeError(f"schema is {_shape(df.schema)}, expected {_shape(expected)}")
    return df


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns matched by name, put in order and widened to ``schema``."""
    return df.to(schema)


def row_map(*names: str) -> Column:
    """Map from column name to value as text."""
    pairs = [part for name in names for part in (F.lit(name), F.col(name).cast("string"))]
    return F.create_map(*pairs)


def create_table(
    spark: SparkSession,
    name: str,
    columns: str,
    path: str | None = None,
    hash_by: str | None = None,
    buckets: int = 3,
) -> None:
    """Create a Parquet table unless it exists; ``columns`` is DDL, ``hash_by`` the bucket column."""
    clustered = f" CLUSTERED BY ({hash_by}) INTO {buckets} BUCKETS" if hash_by else ""
    location = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{clustered}{location}")


def rename_table(spark: SparkSession, name: str, new_name: str) -> None:
    spark.sql(f"ALTER TABLE {name} RENAME TO {new_name}")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")
