"""File scans and the parsing of text lines into columns."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DecimalType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from logweir.functions.text import split_java
from logweir.functions.times import bracket_time

# Number of fields of a raw access-log line and the positions that are used.
ACCESS_LOG_ARITY = 72
ACCESS_LOG_FIELDS = {
    "cdn": 0,
    "region": 1,
    "level": 3,
    "time": 4,
    "ip": 6,
    "domain": 10,
    "url": 12,
    "traffic": 20,
}

# The fields of a cleaned click line.
CLICK_FIELDS = ["cdn", "region", "level", "time", "ip", "domain", "url", "traffic"]


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines in column ``value``; ``spark.sql.files.maxPartitionBytes`` sets the size of its tasks."""
    return spark.read.text(path)


def delimited_columns(lines: DataFrame, sep: str, names: Sequence[str], col: str = "value") -> DataFrame:
    """Named columns of the lines with exactly one field per name. ``lines`` may be a stream."""
    fields = lines.select(split_java(F.col(col), sep).alias("fields"))
    fields = fields.filter(F.size("fields") == len(names))
    return fields.select(*(F.col("fields")[i].alias(name) for i, name in enumerate(names)))


def read_delimited(spark: SparkSession, path: str, sep: str = ",", names: Sequence[str] = CLICK_FIELDS) -> DataFrame:
    """Delimited text with one string column per name; lines of another arity are left out."""
    return delimited_columns(read_lines(spark, path), sep, names)


def parse_access_log(lines: DataFrame, arity: int | None = ACCESS_LOG_ARITY, col: str = "value") -> DataFrame:
    """The eight used fields of tab-separated access-log lines, as strings, the time unbracketed.

    Lines of another arity are left out; with ``arity=None`` a line too short fails the job.
    """
    fields = lines.select(split_java(F.col(col), "\t").alias("fields"))
    if arity is not None:
        fields = fields.filter(F.size("fields") == arity)
    parsed = fields.select(*(F.col("fields")[i].alias(name) for name, i in ACCESS_LOG_FIELDS.items()))
    return parsed.withColumn("time", bracket_time(F.col("time")))


_TYPE_TOKEN = re.compile(r"`(?:[^`]|``)*`|[^\W\d]\w*|\d+|[<>():,]")


def _parse_type(tokens: list[str]) -> DataType:
    """Type of the front tokens, which are taken off; the kinds are those of variant schemas."""
    kind = tokens.pop(0).upper()
    if kind == "OBJECT":
        fields, more = [], tokens.pop(0) == "<" and tokens[0] != ">"
        while more:
            name = tokens.pop(0)
            name = name[1:-1].replace("``", "`") if name.startswith("`") else name
            tokens.pop(0)
            fields.append(StructField(name, _parse_type(tokens)))
            more = tokens[0] == "," and tokens.pop(0) == ","
        tokens.pop(0)
        return StructType(fields)
    if kind == "ARRAY":
        tokens.pop(0)
        inner = _parse_type(tokens)
        tokens.pop(0)
        return ArrayType(inner)
    if kind == "DECIMAL":
        _, precision, _, scale, _ = (tokens.pop(0) for _ in range(5))
        return DecimalType(int(precision), 0) if scale == "0" else DoubleType()
    return {"BIGINT": LongType(), "DOUBLE": DoubleType(), "BOOLEAN": BooleanType()}.get(kind, StringType())


def json_schema(df: DataFrame, col: str) -> StructType:
    """Schema that fits the JSON objects of a column, from one aggregation over it.

    As Spark's JSON reader has it: whole numbers beyond BIGINT are DECIMAL, fractions DOUBLE, and a key that is only
    null or of several kinds is STRING.
    """
    found = df.agg(F.schema_of_variant_agg(F.try_parse_json(col))).first()[0] or ""
    if not found.startswith("OBJECT<"):
        raise ValueError(f"column {col} holds no JSON objects or a mix of kinds")
    return _parse_type(_TYPE_TOKEN.findall(found))


def read_json_strings(df: DataFrame, col: str, schema: StructType | str | None = None) -> DataFrame:
    """Columns of the JSON objects held in a string column; keys absent from a row are NULL.

    The schema is worked out from all rows when none is given.
    """
    parsed = F.from_json(col, schema if schema is not None else json_schema(df, col))
    return df.select(parsed.alias("_json")).select("_json.*")


def sql_on_path(spark: SparkSession, fmt: str, path: str, sql: str = "SELECT * FROM {source}") -> DataFrame:
    """SQL text over files; ``{source}`` stands for the path."""
    return spark.sql(sql.format(source=f"{fmt}.`{path}`"))


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """Parquet partition folders whose columns differ: the union of all columns and the key."""
    return spark.read.option("mergeSchema", True).parquet(path)


def load_ctrl_a(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Text lines with ``\\x01`` between the fields and no quoting, as typed columns.

    ``\\N``, a missing field and a value its type can't hold are NULL; fields beyond the schema are ignored.
    """
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    fields = spark.read.text(path, lineSep="\n").select(F.split("value", "\u0001", -1).alias("f"))
    values = ((F.get("f", F.lit(i)), field) for i, field in enumerate(schema))
    return fields.select(*(F.when(v != "\\N", v).try_cast(field.dataType).alias(field.name) for v, field in values))


def list_files(spark: SparkSession, glob: str) -> DataFrame:
    """Path and length of the files under a glob; their content is not read."""
    return spark.read.format("binaryFile").load(glob).select("path", "length")
