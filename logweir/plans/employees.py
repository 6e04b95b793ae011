"""Employee events: text lines to typed rows in day and hour folders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from logweir.functions import compact_millis, day_of, epoch_millis, hour_of, safe_double, safe_int, split_java
from logweir.operators import observed
from logweir.sinks import write_day_hour
from logweir.sources import read_lines
from logweir.streaming import BatchCounts, append_files, batch_metrics, observed_stream


COUNTS = "employee_lines"


def _typed(lines: DataFrame) -> tuple[DataFrame, Column]:
    """Fields of the lines with a whole-number ``id``, and which lines are usable."""
    fields = lines.select(split_java(F.col("value"), "\t").alias("f"))
    raw = fields.select(*(F.get("f", F.lit(i)).alias(name) for i, name in enumerate(["id", "name", "at", "pay"])))
    return raw.withColumn("id", safe_int(F.col("id"))), F.col("id").isNotNull() & F.col("at").isNotNull()


def _rows(typed: DataFrame, usable: Column) -> DataFrame:
    rows = typed.filter(usable).select(
        "id", "name", epoch_millis(F.col("at")).alias("time"), safe_double(F.col("pay")).alias("salary")
    )
    # Day and hour come from the parsed time, so that each text is parsed once.
    stamped = rows.withColumn("_compact", compact_millis(F.col("time")))
    days = stamped.withColumns({"day": day_of(F.col("_compact")), "hour": hour_of(F.col("_compact"))})
    return days.drop("_compact")


def parse_employees(lines: DataFrame) -> tuple[DataFrame, Observation]:
    """Typed rows of tab-separated lines, and the counts ``total`` and ``errors``.

    Lines without a whole-number id or with fewer than three fields are dropped and counted as
    errors. A bad salary becomes 0.0, a bad time the epoch.
    """
    typed, usable = _typed(lines)
    counted, metrics = observed(typed, COUNTS, total=F.lit(True), errors=~usable)
    return _rows(counted, usable), metrics


def run_stream(lines: DataFrame, out: str, checkpoint: str, counts: str) -> None:
    """Append the rows of a stream of lines to ``out`` by day, until its input is used up.

    A batch is too small for folders by hour; ``hour`` is a column. ``counts`` gets a file for each batch with its ``total`` and ``errors``, see ``batch_counts``.
    """
    typed, usable = _typed(lines)
    rows = _rows(observed_stream(typed, COUNTS, total=F.lit(True), errors=~usable), usable)
    with BatchCounts(lines.sparkSession, COUNTS, counts) as listener:
        listener.wait(append_files(rows, out, checkpoint, partition_by=["day"]))


def batch_counts(spark: SparkSession, counts: str) -> DataFrame:
    """``batch_id, total, errors`` of every batch of ``run_stream``."""
    return batch_metrics(spark, counts, "total long, errors long")


def read_employees(spark: SparkSession, path: str) -> DataFrame:
    """Rows of all batches written by ``run``; ``day`` and ``hour`` stay text."""
    schema = "id int, name string, time bigint, salary double, batch string, day string, hour string"
    return spark.read.schema(schema).parquet(path)


def run(
    spark: SparkSession, source: str, out: str, batch: str | None = None, gather: bool = True
) -> dict[str, int]:
    """Load a batch of text files and write it; returns the ``total`` and ``errors`` counts.

    The batch is named after the source unless a name is given. Running it again replaces its rows
    only. For ``gather`` see ``write_day_hour``.
    """
    batch = batch or source.rstrip("/").rsplit("/", 1)[-1]
    if set(batch) & set("*?[]{}/="):
        raise ValueError(f"name the batch, {batch!r} cannot be a folder name")
    rows, metrics = parse_employees(read_lines(spark, source))
    write_day_hour(rows, out, batch, gather)
    return metrics.get
