"""Aggregations. All shuffle only partial results; ``collect_by`` each distinct value."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from logweir.functions.text import split_java
from logweir.functions.udfs import Aggregator, ArrowAggregator
from logweir.session import materialise


def explode_tokens(df: DataFrame, col: str, sep: str, drop_empty: bool = False, out: str = "word") -> DataFrame:
    """One row per token of ``col``, the other columns repeated."""
    tokens = df.withColumn(out, F.explode(split_java(F.col(col), sep)))
    tokens = tokens.drop(col) if out != col else tokens
    return tokens.filter(F.col(out) != "") if drop_empty else tokens


def word_count(df: DataFrame, col: str, sep: str, drop_empty: bool = False) -> DataFrame:
    """Number of occurrences of each token: columns ``word``, ``count``."""
    return explode_tokens(df.select(col), col, sep, drop_empty).groupBy("word").count()


def count_by(df: DataFrame, *keys: str, out: str = "count") -> DataFrame:
    """Rows per key; NULL is a key of its own."""
    return df.groupBy(*keys).agg(F.count("*").alias(out))


def hits_and_sum(
    df: DataFrame, keys: Sequence[str], value: str, hits: str = "hits", total: str | None = None
) -> DataFrame:
    """Rows per key and the sum of ``value``."""
    return df.groupBy(*keys).agg(F.count("*").alias(hits), F.sum(value).alias(total or value))


def totals(df: DataFrame, **aggs: Column) -> DataFrame:
    """One row of aggregates over all rows; sums of no rows are NULL."""
    return df.agg(*(agg.alias(name) for name, agg in aggs.items()))


def min_max_by(df: DataFrame, key: str, value: str) -> DataFrame:
    """Number of rows, smallest and largest value of each key."""
    return df.groupBy(key).agg(
        F.count("*").alias("rows"), F.min(value).alias("min"), F.max(value).alias("max")
    )


def collect_by(df: DataFrame, key: str, value: str, max_values: int = 100_000) -> DataFrame:
    """Values of each key as sorted arrays of ``(value, copies)``, in rows ``(key, chunk, values)``.

    Chunk k of a key holds its distinct values number k * ``max_values`` and on, in ascending order, so the first
    values are in chunk 0 and no chunk is larger than ``max_values``. Equal values are merged before the shuffle; a
    value's number comes from range partitions and the sizes of those before, so no task holds a hot key whole.
    """
    distinct = df.groupBy(key, value).agg(F.count("*").alias("copies"))
    ranged = materialise(distinct.repartitionByRange(key, value).withColumn("_part", F.spark_partition_id()), "collect")
    inside = Window.partitionBy(key, "_part").orderBy(value)
    earlier = Window.partitionBy("_key").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy(F.col(key).alias("_key"), F.col("_part").alias("_at")).agg(F.count("*").alias("_n"))
    starts = sizes.withColumn("_start", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.col("_part") == F.col("_at"))
    numbered = ranged.withColumn("_row", F.row_number().over(inside)).join(starts, same)
    chunk = F.floor((F.col("_start") + F.col("_row") - 1) / max_values).cast("bigint")
    return numbered.groupBy(key, chunk.alias("chunk")).agg(
        F.array_sort(F.collect_list(F.struct(value, "copies"))).alias("values")
    )


def custom_aggregate(
    df: DataFrame, keys: Sequence[str], value: str, agg: Aggregator, out: str, pending: int = 100_000
) -> DataFrame:
    """Run a custom ``Aggregator`` per key.

    Every task reduces its own rows first, holding at most ``pending`` keys, so a group reaches
    the merge as a few partial results per task however many rows it has. An ``ArrowAggregator`` is grouped and
    merged by Spark itself, with no Python call for a single key.
    """
    keys = list(keys)
    if isinstance(agg, ArrowAggregator):
        return _arrow_aggregate(df, keys, value, agg, out)
    fields = agg.buffer.fieldNames()
    key_fields = [df.schema[k] for k in keys]
    partial_schema = T.StructType([*key_fields, *agg.buffer.fields])
    result_schema = T.StructType([*key_fields, T.StructField(out, agg.result)])
    partial_arrow, result_arrow = to_arrow_schema(partial_schema), to_arrow_schema(result_schema)

    # Keys stay Arrow values: in pandas a NULL would turn whole numbers into floats.
    def reduce_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def frame(buffers: dict) -> pa.RecordBatch:
            columns = zip(*((*k, *b) for k, b in buffers.items()))
            arrays = [pa.array(list(c), field.type) for c, field in zip(columns, partial_arrow)]
            return pa.RecordBatch.from_arrays(arrays, schema=partial_arrow)

        held: dict = {}
        for batch in batches:
            table = pa.Table.from_batches([batch]).append_column("_row", pa.array(range(len(batch)), pa.int64()))
            groups = table.group_by(keys).aggregate([("_row", "list")])
            names = [groups.column(k).to_pylist() for k in keys]
            for k, rows in zip(zip(*names), groups.column("_row_list").combine_chunks()):
                part = agg.reduce(pd.Series(pd.arrays.ArrowExtensionArray(batch.column(value).take(rows.values))))
                if k in held:
                    part = agg.merge(pd.DataFrame([held[k], part], columns=fields))
                held[k] = part
            if len(held) > pending:
                yield frame(held)
                held = {}
        if held:
            yield frame(held)

    def merge_group(group: pa.Table) -> pa.Table:
        result = agg.finish(agg.merge(group.select(fields).to_pandas()))
        columns = [group.column(k).slice(0, 1) for k in keys]
        return pa.Table.from_arrays([*columns, pa.array([result], result_arrow.field(out).type)], schema=result_arrow)

    partial = df.select(*keys, value).mapInArrow(reduce_part, partial_schema)
    return partial.groupBy(*keys).applyInArrow(merge_group, result_schema)


_MERGES = {"sum": F.sum, "min": F.min, "max": F.max}


def _arrow_aggregate(df: DataFrame, keys: list[str], value: str, agg: ArrowAggregator, out: str) -> DataFrame:
    key_fields = [df.schema[k] for k in keys]
    names = [f"_buffer_{name}" for name in agg.buffer.fieldNames()]
    fields = [T.StructField(name, f.dataType) for name, f in zip(names, agg.buffer)]
    rows_schema, result_schema = T.StructType([*key_fields, *fields]), T.StructType([*key_fields, T.StructField(out, agg.result)])
    rows_arrow, result_arrow = to_arrow_schema(rows_schema), to_arrow_schema(result_schema)

    def contribute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = agg.contributions(batch.column(len(keys)))
            cast = (part.cast(rows_arrow.field(name).type) for part, name in zip(parts, names))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keys)], *cast], schema=rows_arrow)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buffers = pa.RecordBatch.from_arrays(batch.columns[len(keys) :], names=agg.buffer.fieldNames())
            values = agg.finish_all(buffers).cast(result_arrow.field(out).type)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keys)], values], schema=result_arrow)

    rows = df.select(*keys, value).mapInArrow(contribute, rows_schema)
    merged = rows.groupBy(*keys).agg(*(_MERGES[agg.merges[f.name]](name).cast(f.dataType).alias(name) for name, f in zip(names, agg.buffer)))
    return merged.mapInArrow(finish, result_schema)


def observed(df: DataFrame, name: str = "metrics", **counts: Column) -> tuple[DataFrame, Observation]:
    """Count conditions while ``df`` is computed; read ``Observation.get`` after an action.

    Each count is the number of rows for which its condition is true.
    """
    observation = Observation(name)
    metrics = [F.count_if(cond).alias(metric) for metric, cond in counts.items()]
    return df.observe(observation, *metrics), observation


def pv_by_domain(df: DataFrame, fields: str = "fields", arity: int = 72, position: int = 10) -> DataFrame:
    """Rows per domain of split log lines; lines of another arity count under ``-``."""
    domain = F.when(F.size(fields) == arity, F.get(fields, F.lit(position))).otherwise("-")
    return df.select(domain.alias("domain"), F.lit(1).alias("times")).groupBy("domain").agg(
        F.count("times").alias("pv")
    )
