"""Streaming sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def stream_lines(spark: SparkSession, fmt: str = "socket", **options: str) -> DataFrame:
    """Stream of text lines in column ``value``, from a socket (host, port) or a text folder (path)."""
    return spark.readStream.format(fmt).options(**options).load()


def stream_files(
    spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet", files_per_batch: int | None = None
) -> DataFrame:
    """Stream of the files of a folder or glob, at most ``files_per_batch`` in a batch."""
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def log_options(
    servers: str,
    topics: str,
    group: str,
    start: str = "latest",
    rate_per_partition: int | None = None,
    partitions: int | None = None,
    batch_seconds: int = 5,
) -> dict[str, str]:
    """Options of a partitioned log stream; ``start`` is ``latest`` or ``earliest``.

    ``rate_per_partition`` is in records per second and becomes a cap per batch.
    """
    if start not in ("latest", "earliest"):
        raise ValueError("start must be latest or earliest")
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topics,
        "groupIdPrefix": group,
        "startingOffsets": start,
    }
    if rate_per_partition:
        if not partitions:
            raise ValueError("a rate per partition needs the number of partitions")
        options["maxOffsetsPerTrigger"] = str(rate_per_partition * partitions * batch_seconds)
    return options


def stream_log(spark: SparkSession, **options) -> DataFrame:
    """Partitioned log stream: ``topic``, ``partition``, ``offset`` and ``value`` as text."""
    log = spark.readStream.format("kafka").options(**log_options(**options)).load()
    return log.selectExpr("topic", "partition", "offset", "CAST(value AS STRING) AS value")
