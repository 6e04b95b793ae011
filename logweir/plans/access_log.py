"""Access-log cleaning: 72 tab fields to eight comma fields."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from logweir.functions import strict
from logweir.sinks import write_text
from logweir.sources import parse_access_log, read_lines


def clean_lines(lines: DataFrame) -> DataFrame:
    """The eight fields of every line; a line too short fails the job."""
    return parse_access_log(lines, arity=None)


def paid_traffic(lines: DataFrame) -> DataFrame:
    """The eight fields of complete lines with traffic above 0; a bad number fails the job."""
    parsed = parse_access_log(lines).withColumn("traffic", strict(F.col("traffic"), "bigint"))
    return parsed.filter(F.col("traffic") > 0)


def run(spark: SparkSession, source: str, out: str, keep_all: bool = False) -> None:
    lines = read_lines(spark, source)
    write_text(clean_lines(lines) if keep_all else paid_traffic(lines), out)
