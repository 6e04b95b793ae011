"""Table, database and external-store sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame


def save_bucketed(
    df: DataFrame,
    table: str,
    n: int,
    cols: Sequence[str],
    sort: Sequence[str] = (),
    partition_by: Sequence[str] = (),
    path: str | None = None,
    gather: bool = False,
    mode: str = "errorifexists",
) -> None:
    """Parquet table in ``n`` hash buckets, sorted within each, optionally partitioned too.

    ``gather`` shuffles the rows by bucket first, for one file per bucket instead of one per task;
    leave it off where a bucket is too large for one task.
    """
    if gather:
        df = df.repartition(n, *cols)
    writer = df.write.mode(mode).format("parquet").bucketBy(n, *cols)
    if sort:
        writer = writer.sortBy(*sort)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    mode: str = "errorifexists",
    column_types: str | None = None,
    props: Mapping[str, str] | None = None,
    connections: int | None = None,
    batch_rows: int = 10_000,
) -> None:
    """Insert rows into a database table, one transaction per partition.

    ``column_types`` is DDL for a table Spark creates. At most ``connections`` are open at a time.
    A task run again after a lost executor inserts again, so give the table a key.
    """
    options = {"url": url, "dbtable": table, "batchsize": str(batch_rows), **dict(props or {})}
    if column_types:
        options["createTableColumnTypes"] = column_types
    if connections:
        options["numPartitions"] = str(connections)
    df.write.format("jdbc").mode(mode).options(**options).save()


def write_external(df: DataFrame, fmt: str, options: Mapping[str, str], mode: str = "append") -> None:
    """Any store with a Spark connector."""
    df.write.format(fmt).mode(mode).options(**dict(options)).save()
