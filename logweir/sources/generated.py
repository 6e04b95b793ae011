"""Rows made by Spark itself."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

# The letters and the number of partitions of the word stream.
LETTERS = "abcdef"
WORD_PARTITIONS = 3


def in_memory(spark: SparkSession, rows: Iterable, schema: StructType | str) -> DataFrame:
    """A small local collection as a DataFrame; a one-type schema gives one column ``value``."""
    return spark.createDataFrame(rows, schema)


def records(spark: SparkSession, n: int) -> DataFrame:
    """Keys 1 to ``n`` with ``val_<key>``."""
    return spark.range(1, n + 1).select(
        F.col("id").alias("key"), F.concat(F.lit("val_"), F.col("id")).alias("value")
    )


def letter_for(number: Column, seed: int = 0) -> Column:
    """A letter picked by hash, the same for the same number and seed."""
    digest = F.md5(F.concat_ws("-", number.cast("string"), F.lit(str(seed))))
    pick = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % len(LETTERS)
    return F.substring(F.lit(LETTERS), (pick + 1).cast("int"), F.lit(1))


def words_for(df: DataFrame, number: str, seed: int = 0) -> DataFrame:
    """A letter and a log partition for each numbered row."""
    return df.select(
        F.col(number).alias("i"),
        (F.col(number) % WORD_PARTITIONS).cast("int").alias("partition"),
        letter_for(F.col(number), seed).alias("word"),
    )


def generate_words(spark: SparkSession, n: int = 10_000, seed: int = 0) -> DataFrame:
    """Numbers 1 to ``n``, each with a letter and a log partition."""
    return words_for(spark.range(1, n + 1), "id", seed)
