"""Reading the given tables, cutting lineage and packing texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from logweir.llm.scan import pack
from logweir.session import materialise


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read again: lost executors repeat no earlier work."""
    return materialise(df, label)


def aside(df: DataFrame, *taken: str) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with columns of the names ``taken`` (in any case) under names that no column has, and their own names."""
    used = {c.lower() for c in [*df.columns, *taken]}
    moved = {}
    for column in df.columns:
        if column.lower() in {t.lower() for t in taken}:
            name = next(n for k in range(len(used) + 1) if (n := f"aside_{k}") not in used)
            used.add(name)
            moved[name] = column
    return df.withColumnsRenamed({column: name for name, column in moved.items()}), moved


def put_back(df: DataFrame, moved: dict[str, str], columns: list[str]) -> DataFrame:
    """The named columns of ``df``, those that ``aside`` moved under their own names again."""
    now = {column: name for name, column in moved.items()}
    return df.select(*(F.col(f"`{now.get(c, c)}`").alias(c) for c in columns))


def packed(docs: DataFrame) -> DataFrame:
    """``docs`` with each text compressed, in the last column ``body_``: shuffles of texts then take less room."""
    rest = [f for f in docs.schema.fields if f.name != "text"]
    return docs.mapInArrow(pack, StructType([*rest, StructField("body_", BinaryType())]))
